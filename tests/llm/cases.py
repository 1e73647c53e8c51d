"""Awkward documents shared by the tests: nulls, empties, long texts, ties, repeats, clashing columns."""

import random

from pyspark.sql import functions as F

CLASHES = [
    "shard", "slot", "size", "fingerprint", "component_id", "root", "print", "hits", "stats", "quality",
    "cut", "kept", "doc", "tag", "text_", "id", "lang_pred", "bytes", "large", "carton", "url_rule", "turns",
]


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    words = ["the", "of", "and", "Ünder", "été", "日本語", "a", "model", "data,", "x1", "<|end|>", "▁", "##"]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base = say(120)
    return [
        None, "", " ", "\n\t ", "a", "A a a", base, base, base + " tail", base.replace("model", "Model", 1),
        say(8000), "x" * 30_000, "😀 é\n\nline\nline\nline", "\x00\x01 <s> </s> <|endoftext|>",
        say(60) + "\n" + base, "one two three four five six seven eight nine ten eleven", say(300), base[:99], base[:100],
    ]


def documents(spark, extra: bool = True):
    rows = [(i, t, ["en", "fr", None][i % 3], "s", None if t is None else len(t)) for i, t in enumerate(texts())]
    rows += [rows[6], rows[6], (3, "another text under the same id", "en", "s", 30), (None, "no id at all", None, "s", 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHES}) if extra else df


def empty(spark):
    return documents(spark).where("false")
