"""Small tables with every awkward case: nulls, empty and long texts, repeats, odd columns."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars int, k1 string, fp string, "
          "line string, term int, row string, `a b` string, shard string, "
          # names that operators use for helper columns
          "__k1 string, __k2 long, __key string, __n int, __lines string, __hits string, __rows int, "
          "__quality string, __id string, __text string")
MORE = ("p", 1, "q", 2, "r", None, 3, "t", "u", "v")
WORDS = ("the of and to in is that it was for on are with as his they at be this from have or by one had "
         "not but what all were when we there can an your which their said if do will each about how up "
         "out them then she many some so these would other into has more her two like him see time could "
         "no make than first been its who now people my made over did down only way find use may water "
         "long little very after words called just where most know").split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def texts(seed=1):
    rng = random.Random(seed)
    base = ["\n".join(sentence(rng, rng.randint(6, 14)) for _ in range(8)) for _ in range(6)]
    common = "Subscribe to our letter and read more stories like this one every single day."
    out = [None, "", " ", "\n\n", "a", "Ünï cödé ß Σίσυφος 中文字符 🙂", "x" * 1000, "ab " * 700,
           base[0], base[0], base[0] + "\n" + common, base[1] + "\n" + common, base[2],
           base[2].replace(" the ", " a ", 1), base[3] + base[0], base[4][100:] + base[4],
           "\t\r\n mixed \x0b white\x0cspace \x00 nul", base[5].upper(),
           "| a | b |\n" * 40, (base[1] + "\n") * 60, common, common + "\n" + common]
    return out


def documents(spark, seed=1, sites=4):
    rows = []
    for i, t in enumerate(texts(seed)):
        rows.append((i * 3, t, "en", f"s{i % sites}", len(t or ""), "x", "y", None, 1, "r", None, "z", *MORE))
    rows.append((None, "A row without an id.", None, None, None, None, None, None, None, None, None, None, *MORE))
    rows.append(rows[8])                       # a repeated row
    rows.append(rows[8])
    rows.append((24, "An id that occurs twice, with another text this time.", "en", "s1", 1, "", "", "", 0,
                 "", "", "", *MORE))
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def not_utf8(spark):
    """(doc_id, text): bytes that are no UTF-8, as Spark's strings may hold them."""
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(1, "FF"), (2, "6120FE6220C3"), (3, "E28220616263"), (4, "6F6B")], "doc_id long, h string")
    return rows.select("doc_id", F.expr("cast(unhex(h) as string)").alias("text"), F.lit("s").alias("source"))


def as_read(spark):
    """The texts of ``not_utf8`` with U+FFFD for what is no UTF-8."""
    return {1: "\ufffd", 2: "a \ufffdb \ufffd", 3: "\ufffd abc", 4: "ok"}


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
