import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bucket int, name string, text_sha256 string, source_size long, size string"


def rows():
    """Nulls, empty and blank texts, one long word, a long text, ties, copies, near copies, repeated rows, and clashing columns."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, long_ = say(60), say(9000)
    near = base.split()
    near[30] = "changed"
    texts = [None, "", " \t\n", "One", "one", "O ne", base, base.upper(), base.replace(" ", "  "), " ".join(near), base + " tail", long_, long_ + " x", "x" * 40_000, "é ▁   😀 ñ", say(5), say(5), base, base]
    out = [(i, t, ["en", "fr", None][i % 3], ["a", "b", None, "é"][i % 4], 1, 2, "n", "s", 3, "z") for i, t in enumerate(texts)]
    out += [out[6], out[6], (None, base, "en", "a", 1, 2, "n", "s", 3, "z"), (None, None, None, None, None, None, None, None, None, None)]
    out += [(100 + i, say(rng.randint(1, 80)), "en", "big", 1, 2, "n", "s", 3, "z") for i in range(40)]
    return out


@pytest.fixture(scope="session")
def raw():
    return rows()


@pytest.fixture(scope="session")
def docs(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs"))
    spark.createDataFrame(raw, SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
