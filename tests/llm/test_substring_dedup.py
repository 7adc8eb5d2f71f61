from shelfscan.llm.substring_dedup import remove_repeats


def brute(rows, width=13):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    owner = {}
    for i, w in words:
        for j in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[j : j + width])
                owner[key] = min(owner.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            if i is not None and owner[tuple(w[j : j + width])] < i:
                gone[j : j + width] = [True] * width
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return out


def key(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def found(docs, **options):
    return [(r["id"], r["n_words"], r["n_removed"], r["kept"]) for r in remove_repeats(docs, **options).collect()]


def test_awkward_rows_equal_brute_force(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    expected = brute(rows)
    assert sorted(found(awkward), key=key) == sorted(expected, key=key)
    assert sum(r[2] for r in expected) > 60_000


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(found(docs), key=key) == sorted(brute(rows), key=key)


def test_mosaic_of_several_sources(spark):
    """Windows that straddle two references, references inside references, and runs just below and at the width."""
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    texts = [a, b, a[:12] + b[:13] + a[20:33], a[5:30] + b[7:19] + ["q"] + b[7:20], (a[:30] + b[:30]), a[25:30] + b[:8] + ["z"] + a, ["k"] * 40, ["k"] * 50]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(found(docs), key=key) == sorted(brute(rows), key=key)
    assert sorted(found(docs, width=5, seed=2), key=key) == sorted(brute(rows, 5), key=key)


def test_empty_table(nothing):
    assert remove_repeats(nothing).collect() == []
