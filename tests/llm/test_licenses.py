from pyspark.sql import functions as F

from shelfscan.llm.licenses import TEMPLATES, scan_licenses

FULL = dict(TEMPLATES)


def scan(spark, rows):
    files = spark.createDataFrame([(*r, "l", "t") for r in rows], "id long, path string, text string, license string, term string")
    return {r["id"]: r for r in scan_licenses(files, "id", F.col("path")).collect()}


def test_headers_files_and_inheritance(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    got = scan(
        spark,
        [
            (1, "LICENSE", "Released under the MIT License."),
            (2, "src/main.c", "int main;"),
            (3, "lib/LICENSE.txt", "Preface\n" + apache + "\nmore text that has nothing to do with it " * 30),
            (4, "lib/a/b/c.py", "x = 1"),
            (5, "lib/d.py", "# " + FULL["GPL-3.0"] + "\nvalue = compute(other, names) " * 20),
            (6, "lib/a/COPYING", FULL["BSD-3-Clause"]),
            (7, "lib/a/b/e.py", "y = license_key"),
            (8, "libx/f.py", None),
            (9, None, ""),
            (10, "top.py", "z"),
        ],
    )
    seen = {i: (r["license"], r["found_in"], r["licensed_by"]) for i, r in got.items()}
    assert seen == {
        1: ("MIT", "file", None),
        2: ("MIT", "inherited", ""),
        3: ("Apache-2.0", "header", None),
        4: ("BSD-3-Clause", "inherited", "lib/a"),
        5: ("GPL-3.0", "header", None),
        6: ("BSD-3-Clause", "file", None),
        7: ("BSD-3-Clause", "inherited", "lib/a"),
        8: ("MIT", "inherited", ""),
        9: (None, None, None),
        10: ("MIT", "inherited", ""),
    }
    assert got[1]["score"] == 1.0


def test_every_template_finds_itself(spark):
    got = scan(spark, [(i, f"f{i}/x", "code\n" + text + "\ncode") for i, (_, text) in enumerate(TEMPLATES)])
    found = [got[i]["license"] for i in range(len(TEMPLATES))]
    has_word = [got[i]["license"] is not None for i in range(len(TEMPLATES))]
    assert all(f == n for f, (n, _), h in zip(found, TEMPLATES, has_word, strict=True) if h) and sum(has_word) >= len(TEMPLATES) - 1


def test_awkward_rows(awkward, nothing, spark):
    rows = scan_licenses(awkward, "doc_id", F.col("lang")).collect()
    assert len(rows) == awkward.count() and all(r["license"] is None for r in rows)
    assert scan_licenses(nothing, "doc_id", F.col("lang")).collect() == []
    twice = spark.createDataFrame([(1, "a/x", "Released under the MIT License.")] * 2 + [(1, "a/x", "none")], "id long, path string, text string")
    got = sorted((r["license"], r["found_in"]) for r in scan_licenses(twice, "id", F.col("path")).collect())
    assert got == [("MIT", "file"), ("MIT", "file"), ("MIT", "inherited")]


def test_plan_is_native(awkward):
    plan = scan_licenses(awkward, "doc_id", F.col("lang"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_lines_of_the_given_tables_and_plain_notices(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "All rights reserved.": "Proprietary",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "SPDX-License-Identifier: MIT": "MIT",
        "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0",
        "# Copyright 2020 Acme Inc. All rights reserved.": "Proprietary",
        "// Copyright (c) 2013 Acme Inc. All rights reserved.": "Proprietary",
        "# SPDX-License-Identifier: Unheard-of": None,
        "see the license of the other file": None,
    }
    got = scan(spark, [(i, f"f{i}/x", "code\n" + line + "\nmore code") for i, line in enumerate(lines)])
    assert [got[i]["license"] for i in range(len(lines))] == list(lines.values())


def test_given_tables_leave_no_licence_line_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = scan_licenses(docs.select("doc_id", "text"), "doc_id", F.col("doc_id").cast("string")).select("id", "license")
    rows = docs.where(F.col("text").contains("All rights reserved.")).join(found, F.col("doc_id") == F.col("id")).select("license").collect()
    assert rows and all(r["license"] is not None for r in rows)
