import itertools
import json
import random

from pyspark.sql import functions as F

from shelfscan.plans import batch
import pytest

from shelfscan.sources import attempt_logs, html_pages, json_payloads, layer_files, staging, versions
from shelfscan.sources.schemas import RAW
from shelfscan.sources.staging import stage


def test_gather_drifting_files(spark, folder):
    rich = spark.createDataFrame([("m", "x", "Tea", 5.0, 123, True)], "store_key STRING, city STRING, product_name STRING, price DOUBLE, sku BIGINT, in_stock BOOLEAN")
    text = spark.createDataFrame([("n", "x", "Milk", "7.5", "s1"), ("n", "x", "Oil", "bad", None)], "store_key STRING, city STRING, product_name STRING, price STRING, sku STRING")
    rich.write.parquet(f"{folder}/raw_m_x.parquet")
    text.write.parquet(f"{folder}/raw_n_x.parquet")
    text.write.parquet(f"{folder}/all_raw_data.parquet")
    with open(f"{folder}/raw_bad_x.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="raw_bad_x"):
        layer_files.gather_raw(spark, folder).collect()
    state = {r["path"].rsplit("/", 1)[1]: (r["path"], r["error"]) for r in layer_files.readable_datasets(spark, folder).collect()}
    assert {n for n, (_, error) in state.items() if error} == {"raw_bad_x.parquet"}
    raw = layer_files.gather_datasets(spark, [path for path, error in state.values() if error is None])
    assert raw.columns == [*[f.name for f in RAW], "row_ord"]
    rows = {r["product_name"]: (r["price"], r["sku"]) for r in raw.collect()}
    assert rows == {"Tea": (5.0, "123"), "Milk": (7.5, "s1"), "Oil": (None, None)}


def test_partition_merge_and_replication(spark, folder):
    def frame(rows):
        return spark.createDataFrame([(*r, (i,)) for i, r in enumerate(rows)], "store_key STRING, city STRING, product_name STRING, price DOUBLE, row_ord STRUCT<row: INT>")

    path = f"{folder}/raw"
    layer_files.write_raw(frame([("s", "x", "Tea", 1.0), ("s", "y", "Tea", 2.0), ("t", "x", "Tea", 3.0)]), path)
    layer_files.merge_into_partitions(spark, path, frame([("s", "x", "Tea", 9.0), ("s", "x", "Oil", 4.0), ("s", "z", "Oil", 5.0)]))
    read = lambda: layer_files.read_layer(spark, path)
    got = {tuple(r) for r in read().select("store_key", "city", "product_name", "price").collect()}
    assert got == {("s", "x", "Tea", 1.0), ("s", "y", "Tea", 2.0), ("t", "x", "Tea", 3.0), ("s", "x", "Oil", 4.0), ("s", "z", "Oil", 5.0)}
    layer_files.replicate_store(spark, path, "s", "x", ["y", "w"])
    assert {r[0] for r in read().filter("store_key = 's'").select("city").distinct().collect()} == {"x", "y", "z", "w"}
    assert read().filter("store_key = 's' AND city = 'w'").count() == 2


def test_old_rows_meet_few_touched_partitions_without_a_shuffle(spark, folder, monkeypatch):
    frame = lambda n, price: spark.range(n).selectExpr("'s' AS store_key", "concat('x', id % 3) AS city", "concat('Tea ', id) AS product_name", f"{price}D AS price", "struct(id AS row) AS row_ord")
    path, written = f"{folder}/raw", []
    layer_files.write_raw(frame(5000, 1.0), path)
    write = layer_files.write_version
    monkeypatch.setattr(layer_files, "write_version", lambda df, *a, **k: (written.append(df), write(df, *a, **k))[1])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        layer_files.merge_into_partitions(spark, path, frame(5010, 2.0), run="new")
        plan = written[0]._jdf.queryExecution().executedPlan().toString()
        # a run that has been committed is not merged again
        layer_files.merge_into_partitions(spark, path, frame(5020, 2.0), run="new")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and len(written) == 1
    assert layer_files.read_layer(spark, path).groupBy("price").count().orderBy("price").collect() == [(1.0, 5000), (2.0, 10)]


def test_one_scan_per_physical_schema(spark, folder):
    for i in range(30):
        kind = ("BIGINT", "STRING", "DOUBLE")[i % 3]
        spark.sql(f"SELECT 's{i}' AS store_key, 'x' AS city, 'Tea' AS product_name, {i}.5D AS price, CAST({i} AS {kind}) AS sku").write.parquet(f"{folder}/raw_s{i}_x.parquet")
    raw = layer_files.gather_raw(spark, folder)
    assert raw._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3
    assert {(r["store_key"], r["price"], r["sku"]) for r in raw.collect()} == {(f"s{i}", i + 0.5, f"{i}.0" if i % 3 == 2 else str(i)) for i in range(30)}


def test_versions_change_as_a_whole_or_not_at_all(spark, folder):
    frame = lambda rows: spark.createDataFrame(rows, "store_key STRING, city STRING, price DOUBLE")
    path, by = f"{folder}/layer", ("store_key", "city")
    assert versions.read_version(spark, path) is None
    first = versions.write_version(frame([("a b", "x", 1.0), ("a b", "5", 2.0), ("c", None, 3.0)]), path, by, "run 1")
    before = sorted(map(str, versions.read_version(spark, path).collect()))
    broken = frame([("a b", "x", 9.0), ("d", "z", 9.0)]).withColumn("price", F.when(F.col("store_key") == "d", F.raise_error(F.lit("stop"))).otherwise(F.col("price")))
    with pytest.raises(Exception, match="stop"):
        versions.write_version(broken, path, by, "run 2", keep_others=True)
    assert sorted(map(str, versions.read_version(spark, path).collect())) == before and versions.snapshot(spark, path).number == 1
    second = versions.write_version(frame([("a b", "x", 7.0), ("d", "z", 8.0)]), path, by, "run 2", keep_others=True)
    again = versions.write_version(frame([("a b", "x", 0.0)]), path, by, "run 2", keep_others=True)
    assert again == second and second.number == 2
    now = {tuple(r) for r in versions.read_version(spark, path).collect()}
    assert now == {("a b", "x", 7.0), ("a b", "5", 2.0), ("c", None, 3.0), ("d", "z", 8.0)}
    assert sorted(map(str, versions.read_version(spark, path, 1).collect())) == before
    with pytest.raises(versions.VersionConflict):
        versions.write_version(frame([("e", "x", 1.0)]), path, by, base=first)
    assert versions.snapshot(spark, path) == second
    pruned = versions.read_version(spark, path).filter("store_key = 'd'")
    assert "PartitionFilters: [isnotnull(store_key" in pruned._jdf.queryExecution().executedPlan().toString()
    versions.write_version(frame([]), path, by)
    assert versions.read_version(spark, path).count() == 0 and versions.read_version(spark, path).columns == ["store_key", "city", "price"]


def test_batch_goes_on_under_its_name(spark, folder, monkeypatch):
    from shelfscan.sources.listings import listings

    raw = listings(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(batch, "match_listings", lambda keyed: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        batch.run(spark, raw, folder, fuzzy=False, run_name="night")
    monkeypatch.undo()
    assert layer_files.read_layer(spark, f"{folder}/matched/matched_products") is None
    paths = batch.run(spark, raw, folder, fuzzy=False, run_name="night")
    assert versions.snapshot(spark, f"{folder}/raw").number == 1 and spark.read.parquet(paths["matched_products"]).count() == 3940


def test_batch_writes_all_layers(spark, folder):
    from shelfscan.sources.listings import listings

    raw = listings(spark, "/root/testdata/sf0.001")
    paths = batch.run(spark, raw, folder, fuzzy=False)
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    assert counts["raw"] == 6053 and counts["processed"] == 5517 and counts["matched_products"] == 3940
    assert counts["match_summary"] == counts["price_dispersion"] == 463
    assert counts["basic_ldi"] > 0 and counts["rejections"] == 1 and len(paths) >= 30
    matched, processed = layer_files.read_matched_pair(spark, paths["matched_products"], f"{folder}/nothing")
    assert matched.count() == 3940 and processed is None


def test_shop_payload_rules(spark):
    products = [
        {"title": " Tea ", "tags": "tea, hot", "variants": [{"price": "5.50", "weight": 0.5, "weight_unit": "kg"}], "images": []},
        {"title": "Milk", "tags": ["baby", "x"], "product_type": "Salt", "variants": [{"price": 7, "compare_at_price": "9"}, {"price": 1}]},
        {"title": "x", "variants": [{"price": "5"}]}, {"title": "Oil", "variants": []}, {"title": "Ghee", "variants": [{"price": "0.0"}]}, {"title": None},
    ]
    payloads = spark.createDataFrame([(0, json.dumps({"products": products})), (1, "not json"), (2, "{}")], "page INT, payload STRING")
    rows = {r["product_name"]: r for r in json_payloads.shop_listings(payloads, "https://s").collect()}
    assert set(rows) == {"Tea", "Milk"}
    assert (rows["Tea"]["category"], rows["Tea"]["weight"], rows["Tea"]["in_stock"]) == ("tea-coffee", "0.5 kg", False)
    assert (rows["Milk"]["category"], rows["Milk"]["price"], rows["Milk"]["old_price"]) == ("staples", 7.0, 9.0)


def test_search_payload_dedup_precedes_filters(spark):
    page = lambda items: json.dumps({"mods": {"listItems": items}})
    payloads = spark.createDataFrame(
        [(0, 1, page([{"itemId": "1", "name": "ab", "price": "5"}, {"nid": "2", "name": "Tea", "price": "x"}, {"itemId": "3", "name": "Rice", "price": "9", "originalPrice": "9", "itemUrl": "//h/dry-food/1"}])),
         (1, 1, page([{"itemId": "1", "name": "Abc", "price": "5"}, {"itemId": "4", "name": "Ghee", "price": "9", "originalPrice": "12"}, {"name": "Noid", "price": "3"}]))],
        "query_no INT, page INT, payload STRING",
    )
    rows = {r["product_name"]: (r["price"], r["old_price"]) for r in json_payloads.search_listings(payloads, "https://m").collect()}
    assert rows == {"Rice": (9.0, None), "Ghee": (9.0, 12.0)}


HTML = """<ul><li class="item product product-item"><a class="product-item-link" href="/x.html"> Tapal  Tea
950g </a><div class="price-box"><span class="old-price"><span class="price">Rs. 1,300</span></span><span data-price-amount="1250.5">
<span class="price">Rs. 1,250</span></span></div><img data-src="//a.jpg" src="b.jpg"></li>
<li class="product-item"><a class="product-item-link">ab</a><li class="product-item"><strong class="product-item-name"><a href="https://h/y">Lux &amp; Soap</a></strong>
<span class="special-price"><span class="price">Rs 95/-</span></span></li></ul>"""
TEXT = """<div class="single_product_theme_x"><a href="/product/1"><img src="i.jpg"></a><b class="product_name_theme"> Oil <i>5l</i></b>Rs. 2,000 Rs.1,800</div>
<div class="single_product_theme"><b class="product_name_theme">Salt</b><span class="cat">Food </span>Rs 50</div><div class="single_product_theme">no name</div>"""


def test_card_pages(spark):
    pages = spark.createDataFrame([("u1", HTML), ("u2", None), ("u3", "<p>nothing <b>here")], "url STRING, html STRING")
    rows = [tuple(r) for r in html_pages.card_listings(pages, html_pages.MAGENTO, "https://s").select("url", "product_name", "price", "old_price", "product_url", "image_url").orderBy("position").collect()]
    assert rows == [("u1", "Tapal Tea 950g", 1250.5, 1300.0, "https://s/x.html", "//a.jpg"), ("u1", "Lux & Soap", 95.0, None, "https://h/y", None)]
    tolerant = html_pages.card_listings(pages, html_pages.TOLERANT_MAGENTO, "https://s", amount_first=False)
    assert [r["price"] for r in tolerant.orderBy("position").collect()] == [1300.0, 95.0]
    texts = spark.createDataFrame([("u", TEXT)], "url STRING, html STRING")
    rows = [tuple(r) for r in html_pages.text_priced_listings(texts, "https://s").select("product_name", "price", "old_price", "category", "product_url").orderBy("position").collect()]
    assert rows == [("Oil5l", 1800.0, 2000.0, "general", "https://s/product/1"), ("Salt", 50.0, None, "food", "")]


LOG = """================
2026-01-01 10:00:00 | storeone     | GET | https://m/a | try=1 | status=? | 120ms | FAIL | HTTPError
2026-01-01 10:00:01 | storeone     | GET | https://m/a | try=2 | status=200 | 90ms | SUCCESS
storeone     | GET | https://m/b | try=1 | status=--- | 10ms | FAIL | ConnectionError: a | b
storeone     | GET | https://m/c | try=1 | status=--- | 20ms | FAIL | Timeout
storetwo     | GET | https://d/c | try=1 | status=429 | 20ms | FAIL | Rate limited
storeone     | GET | https://m/c | try=2 | status=--- | 30ms | FAIL | Timeout
storeone     | GET | https://m/d | try=1 | status=--- | 40ms | FAIL | Timeout
storeone     | GET | https://m/e | try=1 | status=200 | 50ms | SUCCESS
storeone     | GET | https://m/f | try=1 | status=--- | 40ms | FAIL | Timeout"""


def test_attempt_logs(spark, folder):
    with open(f"{folder}/attempts.log", "w") as f:
        f.write(LOG)
    lines = attempt_logs.read_attempts(spark, f"{folder}/attempts.log").withColumn("chunk", (F.col("row_ord.line") / 3).cast("int"))
    attempts = attempt_logs.parse_attempts(lines, "row_ord", "chunk")
    rows = attempts.orderBy("row_ord").collect()
    assert len(rows) == 9 and rows[2]["detail"] == "ConnectionError: a | b" and rows[0]["status"] == "?" and rows[0]["store"] == "storeone"
    totals = {r["store"]: (r["total_requests"], r["failed_requests"]) for r in attempt_logs.attempt_totals(attempts).collect()}
    assert totals == {"storeone": (8, 6), "storetwo": (1, 1)}
    requests = attempt_logs.requests(attempts)
    assert [r["failed"] for r in requests.filter("store = 'storeone'").orderBy("request_no").collect()] == [False, True, True, True, False, True]
    streaks = attempt_logs.failure_streaks(requests).collect()
    assert [(r["store"], r["failures"]) for r in streaks] == [("storeone", 3)]


def test_a_log_folder_equals_the_one_by_one_parser(spark, folder):
    rng = random.Random(3)
    files, expected, noise = {}, {}, 0
    for name in ("a.log", "b.log", "c.log"):
        lines = []
        for _ in range(400):
            store = rng.choice(["shop", "shop", "shop", "other"])
            tries = rng.randint(1, 3)
            bad = rng.random() < 0.6
            for n in range(1, tries + 1):
                last = n == tries
                outcome = "FAIL | HTTPError" if bad or not last else "SUCCESS"
                lines.append(f"{store:<8} | GET | https://x/ | try={n} | status=1 | 5ms | {outcome}")
                if rng.random() < 0.1:
                    lines.append(rng.choice(["", "Traceback", "  | a | b"]))
                    noise += 1
            expected.setdefault(store, []).append(bad)
        files[name] = lines
    for name, lines in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        lines = attempt_logs.read_attempts(spark, folder)
        assert lines.select("chunk").distinct().count() > 6
        assert attempt_logs.unparsed_lines(lines).first()["unparsed_lines"] == noise
        attempts = stage(attempt_logs.parse_attempts(lines, "row_ord", "chunk"), "attempts")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    requests = stage(attempt_logs.requests(attempts), "requests")
    got = {}
    for r in requests.orderBy("row_ord").collect():
        got.setdefault(r["store"], []).append(r["failed"])
    assert got == expected
    streaks = sorted((r["store"], r["failures"]) for r in attempt_logs.failure_streaks(requests).collect())
    wanted = sorted((s, len(list(g))) for s, flags in expected.items() for bad, g in itertools.groupby(flags) if bad for g in [list(g)] if len(g) >= 3)
    assert streaks == wanted


def test_shuffle_files_go_when_a_stage_is_written(spark):
    """A stage is compressed by zstd; frames whose shuffles are gone are computed again."""
    staging.tune(spark)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    expected = sorted((k, len(range(k, 1000, 7))) for k in range(7))
    staged = staging.stage(counts, "counts")
    assert all(".zstd." in f for f in staged.inputFiles())
    for frame in (staged, counts, counts):
        assert sorted(map(tuple, frame.collect())) == expected
    assert counts.count() == 7
