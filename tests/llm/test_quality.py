import re
from collections import Counter

import pyarrow as pa
import sentencepiece

from shelfscan.llm.quality import BANDS, _measured, kept_rows, public_vocabularies, quality_measures

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = [False] * len(words)
    for i in range(len(words) - 4):
        if runs[tuple(words[i : i + 5])] > 1:
            inside[i : i + 5] = [True] * 5
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * sum(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, sum(inside), failed


def test_base_counts_equal_brute_force(awkward, nothing, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    for table in (awkward, docs):
        got = quality_measures(table).collect()
        expected = [(r["doc_id"], *brute(r["text"])) for r in table.collect()]
        assert sorted((tuple(r[:7]) for r in got), key=str) == sorted(expected, key=str)
        assert all(not r["kept"] for r in got if r["base_failed"])
    assert quality_measures(nothing).collect() == []
    kept = kept_rows(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r["kept"] for r in quality_measures(awkward).collect())


def test_fertility_equals_the_vocabulary():
    files = public_vocabularies()
    model = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
    texts = ["The quick brown fox jumps over the lazy dog, and on and on it goes.", "漢字 かな ༀཀ 한글 漢字", ""]
    batch = pa.RecordBatch.from_pydict({"id": [1, 2, 3], "text": texts, "lang": ["en", None, None]})
    for row, text in zip(_measured(batch, files, BANDS).to_pylist(), texts, strict=True):
        ids = [i for word in text.split() for i in model.encode(word)]
        assert row["n_tokens"] == len(ids)
        assert round(row["fallback_share"] * max(1, len(ids))) == sum(model.is_byte(i) for i in ids)
    assert [r["band"] for r in _measured(batch, files, BANDS).to_pylist()] == ["en", "cjk", "other"]


def test_bands_drop_junk_and_keep_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [r for r in quality_measures(docs).collect() if r["id"] in labels and not r["base_failed"]]
    clean = [r["kept"] for r in judged if labels[r["id"]] == 1]
    junk = [r["kept"] for r in judged if labels[r["id"]] == 0]
    assert all(clean) and sum(junk) <= 0.7 * len(junk)
