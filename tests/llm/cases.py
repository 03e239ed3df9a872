"""Small tables with the awkward rows that every operator must take."""

import random

from pyspark.sql import Row
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(("an", "the", "word", "Tree", "river.", "stone", "cloud", "élan", "ñu", "x")) + rng.choice(("", "", "s", "ly")) for _ in range(n))


def texts(seed: int = 3) -> list[str | None]:
    """Null, empty, blank, short, long, repeated and nearly repeated texts."""
    rng = random.Random(seed)
    long = prose(rng, 900)
    near = long.split()
    near[450] = "changed"
    loop = "of " * 300
    some = [prose(rng, rng.randint(1, 60)) for _ in range(40)]
    return [None, "", "  \n\t ", "one", "two words", "one", long, " ".join(near), long, loop, loop + "end", long[1000:1400] + " tail",
            "line a\nline b\nline a\n\nline a", "A B \x1c   日本語 😀", "<s> </s> <|endoftext|> ▁▁ \x00", *some, *some[:3]]


# Names that operators use on the way.
HELPERS = ("_id", "_hash", "_a", "_b", "_key", "_turn", "_order", "_doc", "_row", "_shards", "id", "hash", "unnamed", "text_hash", "row", "turn", "order", "shards",
           "first", "root", "vertex", "number", "place", "p2", "n2", "bucket", "held_out", "predicted", "n_tokens", "start", "item_id", "quality", "taken")


def docs(spark, seed: int = 3, clash: bool = True):
    """The texts with unique ids, a null id, a repeated id, repeated rows, null sources and columns of clashing names."""
    rows = [Row(doc_id=i * 7 % 101, text=t, lang=("en", "de", None)[i % 3], source=("b", "a", "é", None)[i % 4], n_chars=None) for i, t in enumerate(texts(seed))]
    rows += [Row(doc_id=None, text="no id here at all", lang="en", source="a", n_chars=1), rows[6], rows[6], Row(doc_id=rows[7].doc_id, text="same id, other text", lang="en", source="b", n_chars=1)]
    frame = spark.createDataFrame(rows, DOCS)
    if clash:
        for name in ("fingerprint", "component_id", "key", "size", "target", "score", "words", "n_words", "anchor", "region", "decontaminated", "shard", "label",
                     *HELPERS):
            frame = frame.withColumn(name, frame.lang)
    return frame


def empty(spark):
    return spark.createDataFrame([], DOCS)


LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType())])


def rows_of(frame, *names) -> list[tuple]:
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)
