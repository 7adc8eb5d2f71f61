from shelfscan.llm.line_dedup import DIVISOR, WINDOW, deduplicated, remove_repeated_chunks, remove_repeated_passages, settle_chunks

MASK, BASE = (1 << 64) - 1, 0x9E3779B97F4A7C15


def mix(h):
    h ^= h >> 33
    h = h * 0xFF51AFD7ED558CCD & MASK
    h ^= h >> 33
    h = h * 0xC4CEB9FE1A85EC53 & MASK
    return h ^ h >> 33


def sequence(values):
    h = 0
    power = 1
    for v in values:
        h, power = (h + v * power) & MASK, power * BASE & MASK
    return mix((h + len(values) * 0xD6E8FEB86659FD93) & MASK)


def chunks(text):
    lines = text.split("\n")
    hashes = [sequence([b + 1 for b in line.encode()]) for line in lines]
    out, start = [], 0
    for i in range(len(lines)):
        if i == len(lines) - 1 or sequence(hashes[max(0, i - WINDOW + 1) : i + 1]) % DIVISOR == 0:
            out.append(lines[start : i + 1])
            start = i + 1
    return out


def brute(rows):
    first = {}
    for i, text in rows:
        for n, chunk in enumerate(chunks(text) if text is not None and i is not None else []):
            if len(chunk) > 1:
                body = "\n".join(chunk)
                first[body] = min(first.get(body, (i, n)), (i, n))
    out = []
    for i, text in rows:
        if text is None:
            out.append((i, None, 0, 0))
            continue
        parts = [("\n".join(c), len(c), first.get("\n".join(c), (i, n)) != (i, n) and len(c) > 1 and i is not None) for n, c in enumerate(chunks(text))]
        kept = "\n".join(body for body, _, gone in parts if not gone)
        out.append((i, kept, text.count("\n") + 1, sum(n for _, n, gone in parts if gone)))
    return out


def found(docs):
    return sorted(((r["id"], r["text"], r["n_lines"], r["n_removed"]) for r in remove_repeated_chunks(docs).collect()), key=str)


def test_awkward_rows_equal_brute_force(awkward, nothing):
    expected = brute([(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert found(awkward) == sorted(expected, key=str)
    assert sum(r[3] for r in expected) > 1000
    assert remove_repeated_chunks(nothing).collect() == []


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(docs) == sorted(brute([(r["doc_id"], r["text"]) for r in docs.collect()]), key=str)


def test_added_lines_do_not_shift_boundaries(spark):
    body = [f"line {i * 37 % 101} of the passage {i}" for i in range(60)]
    docs = spark.createDataFrame([(1, "\n".join(body)), (2, "\n".join(["new", "lines", *body, "end"]))], "doc_id long, text string")
    rows = {r["id"]: r for r in remove_repeated_chunks(docs).collect()}
    assert rows[1]["n_removed"] == 0 and rows[2]["n_removed"] > 40


def test_stage_keeps_the_columns(awkward):
    out = deduplicated(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()


def brute_pairs(rows):
    """Rows with lines left and removed, one pair of lines after the other."""
    first, found = {}, []
    for i, text in sorted(rows):
        lines = text.split("\n")
        full = [n for n, line in enumerate(lines) if line.strip(" \t\n\v\f\r")]
        for number, (a, b) in enumerate(zip(full, full[1:], strict=False)):
            where = first.setdefault("\n".join(lines[a : b + 1]), (i, number))
            if where[0] != i or number - where[1] >= 2:
                found.append((i, a, b))
    gone = {(i, n) for i, a, b in found for n in range(a, b + 1)}
    kept = {i: [line for n, line in enumerate(text.split("\n")) if (i, n) not in gone] for i, text in rows}
    return sorted((i, "\n".join(kept[i]), text.count("\n") + 1, text.count("\n") + 1 - len(kept[i])) for i, text in rows)


def passages(docs):
    return sorted(tuple(r) for r in remove_repeated_passages(docs).collect())


def test_every_short_passage_is_found(spark):
    planted = [[f"passage {p} line {n} of it" for n in range(2 + p % 2)] for p in range(40)]
    rows = [(i, "\n".join([f"before {i}", *planted[i % 40], f"after {i}", "", f"end {i}"])) for i in range(120)]
    rows += [(200, "same\nsame\nsame\nsame\nsame"), (201, "a\n\nb\n\n\nc"), (202, "x\na\n\nb"), (203, "\n\n\n"), (204, "a\nb")]
    got = passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute_pairs(rows)
    left = {r[0]: r[1] for r in got}
    assert all(left[i] == f"before {i}\nafter {i}\n\nend {i}" for i in range(40, 120)) and left[200] == "same\nsame" and left[202] == "x"


def test_passages_of_documents_equal_brute_force(spark, awkward, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null")
    assert passages(docs) == brute_pairs([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert remove_repeated_passages(nothing).collect() == [] and remove_repeated_passages(awkward).count() == awkward.count()


def test_chunks_settle_long_passages_before_pairs(spark):
    body = [f"line {i * 37 % 101} of the passage {i}" for i in range(200)]
    rows = [(1, "\n".join(body)), (2, "\n".join(["new", "lines", *body, "end"])), (3, "\n".join(body[90:])), (4, "\n".join([body[7], "", body[8], *body[8:12]]))]
    chunks, pairs = settle_chunks(spark.createDataFrame(rows, "id long, text string"))
    settled, left = chunks.groupBy("id").count().collect(), dict(pairs.groupBy("id").count().collect())
    # all pairs of a first occurrence go on; of a copy only those at the edges and across outer cuts
    assert {r["id"] for r in settled} >= {2, 3} and left[1] == 199 and left[2] < 50 and left[3] < 30
    assert passages(spark.createDataFrame(rows, "doc_id long, text string")) == brute_pairs(rows)


def test_rows_of_one_id_keep_what_stands_at_one_place(spark):
    """Chunks of rows that share an id have the place of their first pair, as pairs have."""
    body = [f"line {i * 37 % 101} of the passage {i}" for i in range(60)]
    heads = [[], ["one more"], ["two", "more"]]
    for head in heads:
        rows = [(5, "\n".join(body), 0), (5, "\n".join([*head, *body]), 1)]
        got = sorted(r["n_removed"] for r in remove_repeated_passages(spark.createDataFrame(rows, "doc_id long, text string, n int")).collect())
        assert got == ([0, 60] if len(head) == 2 else [0, 0])
