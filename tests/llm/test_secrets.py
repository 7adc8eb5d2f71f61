import random
import time

from pyspark.sql import functions as F

from shelfscan.llm.secrets import FEATURES, candidates, judged, scan_secrets, train, with_features

HEX, MIXED = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def labelled_texts(seed, n):
    """Secrets and look-alikes with overlapping context: the label is known, and follows from no one feature."""
    rng, out = random.Random(seed), []
    random_text = lambda letters, size: "".join(rng.choice(letters) for _ in range(size))
    for i in range(n):
        kind = rng.randrange(6)
        if kind == 0:
            out.append((f'{rng.choice(["token", "api_key", "secret", "password"])} = "{random_text(HEX, 40)}" in use', "src/app.py", 1.0))
        elif kind == 1:
            out.append((f"auth bearer {random_text(MIXED, rng.randint(24, 48))} sent", rng.choice(["config/prod.env", "src/app.py"]), 1.0))
        elif kind == 2:
            out.append((f"see commit {random_text(HEX, 40)} for more", "README.md", 0.0))
        elif kind == 3:
            out.append((f'token = "example{random_text(MIXED, 14)}1" as a sample', "docs/guide.md", 0.0))
        elif kind == 4:
            out.append((f"card {random_text('0123456789', 16)} paid", "src/app.py", 0.0))
        else:
            words = "".join(rng.choice(["user", "name", "file", "index", "value", "port"]) for _ in range(5))
            out.append((f"secret {words}{rng.randint(1, 9)} is a name", "src/app.py", 0.0))
    return [(i, *row) for i, row in enumerate(out)]


def findings(spark, seed, n):
    rows = spark.createDataFrame(labelled_texts(seed, n), "doc_id long, text string, source string, label double")
    found = with_features(candidates(rows))
    return found.join(rows.select(F.col("doc_id").alias("id"), "label"), "id")


def test_held_out_accuracy(spark):
    model = train(findings(spark, 1, 600))
    held_out = judged(findings(spark, 2, 300), model).select("label", "is_secret").collect()
    right = [r["is_secret"] == (r["label"] == 1.0) for r in held_out]
    assert len(right) >= 290 and sum(right) >= 0.97 * len(right)


def test_training_sample_is_bounded(spark):
    assert train(findings(spark, 3, 300), sample=20) is not None
    assert train(findings(spark, 3, 60).where("label = 1")) is None


def test_candidates_and_features(spark):
    text = 'set token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" and {"a":"AAAA1111bbbb2222cccc","b":"DDDD3333eeee4444ffff"} plainlowercaselongword'
    docs = spark.createDataFrame([(1, text, "config/x.env"), (2, None, None), (3, "", "a"), (None, text, None)], "doc_id long, text string, source string")
    rows = with_features(candidates(docs)).where("id = 1").orderBy("at", "value").collect()
    assert [r["value"][:6] for r in rows] == ["f33e61", "AAAA11", "DDDD33"]
    first = rows[0].asDict()
    assert (first["length"], first["keyword_near"], first["assigned"], first["quoted"], first["config_path"]) == (40, 1, 1, 1, 1)
    assert rows[1]["transitions"] == 4 / 19 and set(FEATURES) <= set(first)


def test_awkward_rows(awkward, nothing):
    assert scan_secrets(awkward, path_col="lang").where("probability is not null").count() == 0
    assert scan_secrets(nothing, path_col="lang").collect() == []


def test_plan_is_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = candidates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_values_after_a_keyword_are_whole_candidates(spark):
    texts = {
        'password = "S3cr3t!pass"': ["S3cr3t!pass"], "db_pwd=hunter2": ["hunter2"], "passwd: p@ss$word-2024": ["p@ss$word-2024"],
        "token=eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.c2ln": ["eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.c2ln"],
        '{"password":"a!b","token":"c?d"}': ["a!b", "c?d"], "a plain short word=abc": [],
    }
    docs = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = candidates(docs).collect()
    assert [sorted(r["value"] for r in rows if r["id"] == i) for i in range(len(texts))] == list(texts.values())


def values_of(spark, text):
    found = candidates(spark.createDataFrame([(1, text, "p")], "doc_id long, text string, source string"))
    return sorted({r["value"] for r in found.collect()})


def test_values_end_where_they_should(spark):
    assert "abc.def.ghi" in values_of(spark, "Authorization: Bearer abc.def.ghi")
    assert values_of(spark, "url?token=abc&secret=def&x=1") == ["abc", "def"]
    assert values_of(spark, "password=a&b, token =v9 api key: zzz9;") == ["a&b", "v9", "zzz9"]
    assert values_of(spark, '{"api_key":"k,1","secret":"k2"}') == ["k,1", "k2"]


def test_very_long_words_take_one_look(spark):
    """Words that once filled the stack or were read again from every keyword."""
    started = time.time()
    emoji = "a\N{GRINNING FACE}" * 100_000
    assert values_of(spark, "token=" + emoji) == [emoji]
    assert values_of(spark, "token," * 200_000) == []
    assert values_of(spark, 'token="a"' * 20_000) == ["a"]
    assert values_of(spark, "token=" + "a&" * 300_000 + "b") == ["a&" * 300_000 + "b"]
    assert values_of(spark, "token=x" + "=" * 500_000) == ["x"]
    assert values_of(spark, "secret" + '"' * 500_000) == []
    assert time.time() - started < 60
