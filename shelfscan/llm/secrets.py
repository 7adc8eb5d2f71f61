"""Secret scans: a broad candidate rule, and a random forest that removes its false positives.

Candidates are values that follow a keyword and ``=`` or ``:`` up to white space or the closing quote, of any length and with any marks,
and runs of 16 or more of ``A-Za-z0-9+/_-`` (with ``=`` at the end) that hold a digit or stand
near a keyword. A candidate is described by its length, its character transitions (changes
between upper case, lower case, digits and marks), shares of digits, upper case and
distinct characters, the share of it that a dictionary of common pieces covers, its path, and the
words around it. The forest is trained from labelled findings, on a bounded sample:
``SAMPLE`` rows of each label at most, those with the smallest hashes. Everything is scored.

* null or empty text: no findings; null path: no path features set
* null id and repeated rows: findings like any others
* very long texts and words: patterns read a name or value once, without a group that repeats, so time grows with the word and no
  stack is filled; ``LEAD`` characters before a value in its word count as its surroundings
* labels of one kind only, or none: nothing can be learned, all candidates are kept with a null probability
* empty table: empty result; other columns are ignored

DataFrame expressions and the DataFrame-based forest of Spark only. One pass over the text finds candidates;
they are staged, since they are few and read twice.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.sources.staging import stage

SAMPLE = 5000
TREES = 20
DEPTH = 6
SEED = 7
MIN_LENGTH = 16
SHAPE = rf"[A-Za-z0-9+/_\-]{{{MIN_LENGTH},}}={{0,2}}"
#: Words that stand near secrets, near look-alikes, and near made-up examples; parts of ordinary words.
KEYWORDS = r"(?i)token|secret|passw|pwd|api.?key|access.?key|private.?key|credential|auth|bearer"
#: A name that holds a keyword, from its first character on, so that a long name is read once.
_NAME = (
    r"(?i)(?<![\w.\-])(?=[\w.\-]*?(?:" + KEYWORDS.replace("(?i)", "") + r"))[\w.\-]++(?:(?<=api|access|private)[^\w.\-]key[\w.\-]*+)?+"
    r"""["'\])]*+\s*+"""
)
_GIVEN = r"""["'`]?+((?<=")[^"\s]++|(?<=')[^'\s]++|(?<=`)[^`\s]++|(?<!["'`])[^\s"'`]*[^\s"'`,;)}\]:=])"""
_SIGN = r"(?:=>|[:=]++)"
_SCHEME = r"(?:bearer|basic)?+"
#: Name, = or : and value, all in one word.
ASSIGNED = _NAME + _SIGN + _GIVEN
#: The same with the value in the word after the mark, where words before it end in name and sign, or in the name.
CROSSING = _NAME + r"(?:" + _SIGN + r"\s*+" + _SCHEME + "\u0001" + r"|\u0001" + _SIGN + r")" + _GIVEN
ASSIGNMENT = _NAME + "[:=]"
_KEPT_HEAD = "(" + _NAME + _SIGN + r"""["'`]?+)""" + _GIVEN.removeprefix("""["'`]?+""")
#: Where a value of a query string ends.
NEXT_PARAMETER = r"&(?=\w++=)"
#: Characters before a value that are looked at.
LEAD = 200
HASHES = r"(?i)commit|sha\d*|md5|checksum|digest|etag|uuid|guid|revision|integrity"
EXAMPLES = r"(?i)example|sample|dummy|fake|test|placeholder|your|xxx"
CONFIG_PATH = r"(?i)\.(env|ya?ml|ini|toml|cfg|conf|properties|json)$|(^|/)\.?(config|settings|secrets?)"
TEST_PATH = r"(?i)(^|[/_.\-])(tests?|spec|examples?|fixtures?|docs?|samples?)([/_.\-]|$)"
DICTIONARY = (
    "the and ing ion ent tion for ter ate with that this from have not are was our per ver con com pro pre dis able ness ment less ful ous "
    "ist ity age ship man land port form light time work day way side line house water ground back over under out down up off key name user "
    "data file list table index value type class object string number main test code base set get in on at er re an es th he ed or st ea en "
    "ti ou ha nd it is of ly sh wh nt"
).split()

FEATURES = (
    "length", "transitions", "digit_share", "upper_share", "distinct_share", "dictionary", "keyword_near", "hash_word_near",
    "example_near", "assigned", "quoted", "config_path", "test_path",
)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """id, path, at (number of the word, from 0), value, before (two words), after, lead (what precedes the value in its word)."""
    path = F.col(path_col).cast("string") if path_col else F.lit(None).cast("string")
    plain = docs.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text_col).cast("string").alias("text"))
    words = F.split("text", r"[\x20\x09-\x0D]+")
    around = lambda i: F.coalesce(F.get("words", i), F.lit(""))

    none = F.array().cast("array<string>")

    def found(word: Column, i: Column) -> Column:
        before = F.concat_ws(" ", around(i - 2), around(i - 1))
        first = F.when(F.col("assigns"), F.regexp_extract(F.concat(before, F.lit("\u0001"), F.split(word, NEXT_PARAMETER, 2)[0]), CROSSING, 1)).otherwise("")
        run = (F.length(word) >= MIN_LENGTH) & word.rlike(SHAPE)
        assigns = F.col("assigns") & word.rlike(ASSIGNMENT)
        near = F.struct(
            i.alias("at"), word.alias("word"), before.alias("before"), around(i + 1).alias("after"), first.alias("first"), assigns.alias("assigns")
        )
        return F.when(run | assigns | (first != ""), near)

    hits = F.filter(F.transform("words", found), lambda hit: hit.isNotNull())
    assigns = F.col("text").rlike(ASSIGNMENT)
    rows = plain.where(F.col("text").rlike(SHAPE) | assigns).select("id", "path", words.alias("words"), assigns.alias("assigns"))
    rows = rows.select("id", "path", F.explode(hits).alias("hit")).select("id", "path", "hit.*")
    rest = F.expr("if(first = '', word, substring(word, locate(first, word) + length(first)))")
    rows = rows.withColumn("rest", rest)
    parts = F.split("rest", NEXT_PARAMETER)
    inside = F.when(F.col("assigns"), F.flatten(F.transform(parts, lambda p: F.regexp_extract_all(p, F.lit(ASSIGNED), F.lit(1))))).otherwise(none)
    given = F.concat(F.when(F.col("first") != "", F.array("first")).otherwise(none), inside)
    rows = rows.withColumn("given", F.filter(given, lambda g: g != ""))
    # what is left when values are taken out
    left = F.when(F.col("assigns"), F.regexp_replace("rest", _KEPT_HEAD, "$1 ")).otherwise(F.col("rest"))
    runs = F.array_except(F.regexp_extract_all(left, F.lit(SHAPE), F.lit(0)), "given")
    rows = rows.withColumn("value", F.explode(F.array_distinct(F.concat("given", runs))))
    rows = rows.withColumn("lead", F.expr(f"right(substring_index(word, value, 1), {LEAD})"))
    known = F.array_contains("given", F.col("value")) | F.col("value").rlike(r"\d") | F.concat_ws(" ", "before", "lead").rlike(KEYWORDS)
    return rows.where(known).drop("word", "given", "first", "assigns", "rest")


def _share(value: Column, left_out: str) -> Column:
    """Share of the characters that a pattern matches."""
    return 1 - F.length(F.regexp_replace(value, left_out, "")) / F.length(value)


def with_features(findings: DataFrame) -> DataFrame:
    """The findings with a double column for each of FEATURES; needs value, before, after, lead, path."""
    value = F.col("value")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    runs = F.regexp_replace(F.regexp_replace(kinds, "[^aA0]", "-"), r"(.)\1+", "$1")
    near = F.concat_ws(" ", "before", "lead", "after")
    ahead = F.concat_ws(" ", "before", "lead")
    pieces = "(?i)" + "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    columns = {
        "length": F.length(value),
        "transitions": (F.length(runs) - 1) / F.greatest(F.length(value) - 1, F.lit(1)),
        "digit_share": _share(value, "[0-9]"),
        "upper_share": _share(value, "[A-Z]"),
        "distinct_share": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "dictionary": _share(value, pieces),
        "keyword_near": ahead.rlike(KEYWORDS),
        "hash_word_near": near.rlike(HASHES),
        "example_near": F.concat_ws(" ", near, value).rlike(EXAMPLES),
        "assigned": ahead.rlike(r"[=:]\s*[\"']?$"),
        "quoted": F.col("lead").rlike("[\"']$"),
        "config_path": F.coalesce(F.col("path").rlike(CONFIG_PATH), F.lit(False)),
        "test_path": F.coalesce(F.col("path").rlike(TEST_PATH), F.lit(False)),
    }
    return findings.withColumns({name: columns[name].cast("double") for name in FEATURES})


def labelled_by_context(findings: DataFrame) -> DataFrame:
    """Findings that their context settles, with a label: 1 for a quoted value assigned to a keyword, 0 for digits only and mail addresses.

    The stand-in for reviewed findings where there are none; undecided findings are left out.
    """
    secret = (F.col("keyword_near") == 1) & (F.col("assigned") == 1) & (F.col("quoted") == 1) & (F.col("example_near") == 0)
    clean = F.col("value").rlike(r"^[0-9+\-]+$") | F.col("lead").contains("@") | (F.col("hash_word_near") == 1)
    return findings.withColumn("label", F.when(secret, F.lit(1.0)).when(clean, F.lit(0.0))).where("label is not null")


def train(labelled: DataFrame, sample: int = SAMPLE) -> RandomForestClassificationModel | None:
    """Forest from findings with features and label; None if a label is missing. Reads ``sample`` rows of each label at most."""
    order = (F.xxhash64("value", "before", "after"), F.col("value"))
    part = lambda label: labelled.where(F.col("label") == label).select("label", *FEATURES, "value", "before", "after").orderBy(*order).limit(sample)
    rows = stage(part(0.0).unionByName(part(1.0)).select("label", *FEATURES), "labelled")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    return forest.fit(_assembled(rows))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)


def judged(findings: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """The findings with probability and is_secret."""
    if model is None:
        return findings.withColumn("probability", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    scored = model.transform(_assembled(findings)).withColumn("probability", F.round(vector_to_array("probability")[1], 6))
    return scored.drop("features", "rawPrediction", "prediction").withColumn("is_secret", F.col("probability") >= threshold)


def scan_secrets(
    docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source"
) -> DataFrame:
    """Every candidate of every text with its features, probability and is_secret; ``labelled`` has reviewed findings with features and label."""
    findings = stage(with_features(candidates(docs, id_col, text_col, path_col)), "findings")
    return judged(findings, train(labelled if labelled is not None else labelled_by_context(findings)))
