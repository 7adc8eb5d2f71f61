import pytest
from pyspark.sql import functions as F

from shelfscan.operators import views
from shelfscan.plans.layers import layers_of
from shelfscan.sources import name_index


@pytest.fixture(scope="module")
def index(spark):
    import tempfile

    layer = layers_of(spark, "/root/testdata/sf0.001").processed
    odd = ["\N{KELVIN SIGN}ettle large", "Café crème 5ml", "a.b+c (x)", "ab", "", None, "LARGE Gear", "straße large"]
    extra = layer.limit(len(odd)).withColumn("product_name_clean", F.get(F.array(*map(F.lit, odd)), F.monotonically_increasing_id().cast("int") % len(odd)))
    layer = layer.unionByName(extra)
    folder = tempfile.mkdtemp(prefix="shelfscan-test-")
    layer.write.parquet(f"{folder}/layer")
    layer = spark.read.parquet(f"{folder}/layer")
    name_index.build_name_index(layer, f"{folder}/index")
    return layer, f"{folder}/index"


@pytest.mark.parametrize(
    "pattern,literal",
    [("gear", False), ("large gea?r", False), ("lar.*medium", False), ("kettle", False), ("[bl]arge", False), (r"\d{2} ?ml$", False), ("gear|bolt", False),
     ("(large|small) rod", False), ("a.b+c (", True), ("GEAR", True), ("é", True), ("", True), ("ab", True), ("no such name", False), ("large+ gear", False), (r"12\s*lb", False)],
)
def test_rows_equal_the_scan(spark, index, pattern, literal):
    layer, path = index
    key = lambda df: sorted(map(str, df.collect()))
    got = key(name_index.indexed_search(spark, path, pattern, literal=literal))
    assert got == key(views.search(layer, pattern, literal=literal))
    stores = ["africa", "asia"]
    assert key(name_index.indexed_search(spark, path, pattern, stores, ["building"], literal)) == key(views.search(layer, pattern, stores, ["building"], literal))


def test_only_shards_of_the_trigrams_are_read(spark, index):
    _, path = index
    assert name_index.sure_trigrams("gear") == ["ear", "gea"] and name_index.sure_trigrams("ge?ar") == []
    assert name_index.sure_trigrams(r"red\.x [a-z]+ big") == [" bi", ".x ", "big", "d.x", "ed.", "red"]
    assert name_index.sure_trigrams("large+ bolt") == [" bo", "arg", "bol", "e b", "lar", "olt", "rge"]
    read = name_index.candidate_postings(spark, path, ["gea", "ear"])
    shards = {f.split("shard=")[1].split("/")[0] for f in spark.read.parquet(f"{path}/postings").inputFiles()}
    used = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in used and "shard" in used.split("PartitionFilters: [")[1].split("]")[0] and "PushedFilters: [In(gram" in used
    assert len(shards) > 20 and read.select("shard").distinct().count() <= 2


def test_trigrams_are_made_once(spark, folder, monkeypatch):
    """Ranges of postings would be sampled first, by making all trigrams."""
    layer = spark.sql("SELECT 'large gear' AS product_name_clean")
    monkeypatch.setattr(type(layer), "repartitionByRange", lambda *a: pytest.fail("sampled"))
    name_index.build_name_index(layer, folder)
    held = spark.read.parquet(f"{folder}/postings")
    assert sorted(r[0] for r in held.select("gram").collect()) == sorted({"large gear"[i : i + 3] for i in range(8)})
