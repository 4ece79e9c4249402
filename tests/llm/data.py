"""Small tables with the awkward cases every operator has to stand."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "id string, node string, size string, uid string, seed string, features string, host string")


def word(rng: random.Random) -> str:
    return "".join(rng.choice(["an", "the", "or", "is", "ne", "lo", "qua", "ré"]) for _ in range(rng.randint(1, 4)))


def prose(rng: random.Random, n: int) -> str:
    words = [word(rng) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", ".\n", ", "]) for w in words).strip()


def rows(seed: int = 7) -> list[tuple]:
    """Copies, near copies, nulls, empty and long texts, repeated rows; columns that clash with internal names."""
    rng = random.Random(seed)
    texts: list[str | None] = [prose(rng, rng.randint(1, 120)) for _ in range(40)]
    base = prose(rng, 150)
    near = base.split(" ")
    for k in range(6):
        copy = list(near)
        copy[10 * k + 3] = "changed" + str(k)
        texts.append(" ".join(copy))
    texts += [base, base.upper(), base, texts[0], texts[1]]
    texts += [None, "", " ", "\n\n", "one", "One", "two words", "A b C", prose(rng, 30_000), "x" * 200_000]
    texts += ["same phrase again and once more " * 30, "line\nline\nline\nother"]
    out = [(i, t, "en", f"src{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    out += [(None, base, "en", "src1", 1), (None, None, None, None, None), out[3], out[3], out[44]]
    return [r + ("a", "b", "c", "d", "e", "f", "g") for r in out]


def docs(spark: SparkSession, data: list[tuple] | None = None) -> DataFrame:
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(5)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def simple(spark: SparkSession, texts: list[str | None], source: str = "s") -> DataFrame:
    return docs(spark, [(i, t, "en", source, 0, *"abcdefg") for i, t in enumerate(texts)])
