"""Embed the texts of a JSON file: ``python -m docweave.embed FILE [BACKEND]`` reads {"texts": [...]} and prints {"model": ..., "embeddings": [...]}."""

from __future__ import annotations

import json
import sys

from pyspark.sql import functions as F

from docweave.operators import vectors
from docweave.session import local, ship


def embed_texts(spark, texts: list[str], backend: str = "hash", **options) -> dict:
    """The embeddings in the order of the texts, which come from the caller and go back to it."""
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    made = vectors.embed(rows, "text", backend, **options).select("i", F.col("embedding")).orderBy("i").collect()
    return {"model": backend, "embeddings": [[float(x) for x in r.embedding] for r in made]}


def main() -> None:
    with open(sys.argv[1], encoding="utf-8") as f:
        texts = json.load(f)["texts"]
    spark = local()
    ship(spark)
    print(json.dumps(embed_texts(spark, texts, *sys.argv[2:3])))


if __name__ == "__main__":
    main()
