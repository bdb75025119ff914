"""Small tables that hold what real ones do at their worst."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["score", "n", "key", "row_id", "label", "f1", "path", "task", "kept", "host"]


def rows(seed=3):
    """(doc_id, text, lang, source, n_chars): nulls, empty and blank texts, near
    and exact copies, one very long text, repeated rows, odd code points."""
    rnd = random.Random(seed)
    words = ["the", "river", "Stone", "bleu", "élan", "straße", "x1", "Ende.", "and,", "über", "señor", "don't", "A-B",
             "中文", "😀", "&", "#tag", "K", "ſ", "İ"]
    texts = []
    for _ in range(24):
        texts.append("\n".join(" ".join(rnd.choice(words) + (str(rnd.randint(0, 99)) if rnd.random() < .6 else "")
                                        for _ in range(rnd.randint(3, 30))) for _ in range(rnd.randint(1, 6))))
    near = texts[0].split(" ")
    near[len(near) // 2] = "changed"
    texts += [texts[0], " ".join(near), texts[1] + " tail", texts[1], "", " \t\n\x0b\f\r ", None, "one", "two words",
              "one two three four", "ONE two three FOUR", "\x1cctl\x1f \x85 nbsp\xa0x", "a " * 40,
              "<|endoftext|> in <|startoftext|>text", "\n\n\n", "long " + " ".join(f"w{i % 977}" for i in range(9000))]
    out = [(i * 3, t, "en", f"h{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    out += [out[2], out[2], (None, texts[3], None, None, None), (None, None, None, None, None),
            (7, texts[4], None, "h0", 1), (7, texts[5], "de", None, None)]
    return out


def docs(spark, some=None, partitions=3):
    df = spark.createDataFrame(rows() if some is None else some, SCHEMA).repartition(partitions)
    for c in EXTRA:
        df = df.withColumn(c, F.lit(None).cast("string"))
    return df


def empty(spark):
    return docs(spark, [], 1)


def key(x):
    return tuple((v is not None, v) for v in x)
