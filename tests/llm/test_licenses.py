"""License scans of odd texts, of more notices, and against the SQL on texts that need every reading."""

import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from tabsift.llm import licenses

ODD = {
    "copyright signs": "©" * 100_000, "dashes": "-" * 100_000, "mark and dashes": "(c) " + "-" * 100_000, "word and dashes": "copyright" + "-" * 100_000,
    "lines of signs": "©\n" * 50_000, "brackets": "(" * 100_000, "no end": "x license (" + "a" * 100_000, "tokens": "a.-" * 40_000,
    "words": "word " * 40_000, "marks": "\x01\x02" * 20_000, "returns": "\r" * 50_000, "dots": ". " * 50_000,
}
NOTICES = {
    "isc": ("ISC", "ISC License\n\nCopyright (c) 2020, Some One\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose "
            "with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n"),
    "lgpl": ("LGPL-2.1-or-later", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General "
             "Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later "
             "version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty "
             "of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU\nLesser General Public License for more details.\n"),
    "agpl": ("AGPL-3.0-or-later", "    This program is free software: you can redistribute it and/or modify\n    it under the terms of the GNU Affero "
             "General Public License as published\n    by the Free Software Foundation, either version 3 of the License, or\n    (at your option) "
             "any later version.\n"),
    "zlib": ("Zlib", "This software is provided 'as-is', without any express or implied\nwarranty.  In no event will the authors be held liable for any "
             "damages\narising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding "
             "commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:\n"),
    "cc0": ("CC0-1.0", "# To the extent possible under law, the author(s) have dedicated all\n# copyright and related and neighboring rights to this "
            "software to the\n# public domain worldwide. This software is distributed without any\n# warranty.\n"),
    "boost": ("BSL-1.0", "// Distributed under the Boost Software License, Version 1.0.\n//    (See accompanying file"),
    "epl": ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is "
            "available at https://www.eclipse.org/legal/epl-2.0/\n"),
    "spdx": ("AGPL-3.0-only", "/* SPDX-License-Identifier: AGPL-3.0-only */\ncode"),
    "old mac": ("MIT", "Some words\rReleased under the MIT License.\rmore"),
}


def scanned(spark, rows, **tables):
    df = spark.createDataFrame(rows, "doc_id string, text string")
    return {r["doc_id"]: r for r in licenses.scan_licenses(df, **tables).collect()}


def test_odd_texts_take_linear_time(spark):
    rows = [(f"{name} {n}", t) for name, text in ODD.items() for n, t in enumerate((text, text + "\n", "x\n" + text, text + " released under the mit license"))]
    began = time.time()
    got = scanned(spark, rows)
    assert time.time() - began < 60 and len(got) == len(rows)
    assert got["dots 3"]["licenses"] == ["MIT"] and not got["dots 0"]["licenses"]


def test_more_notices(spark):
    got = scanned(spark, [(name, text) for name, (_, text) in NOTICES.items()])
    assert {name: r["licenses"] for name, r in got.items()} == {name: [license] for name, (license, _) in NOTICES.items()}


def test_given_tables(spark):
    sentences = spark.createDataFrame([("x1", "Free for ALL uses."), ("x2", "but not: here")], "id string, sentence string")
    rules = spark.createDataFrame([("x1 x2", "Mine"), ("x1", "Other")], "rule string, license string")
    known, named = licenses.sentence_table(sentences, rules)
    assert known == {"x1": "free for all uses", "x2": "but not here"}
    got = scanned(spark, [("a", "Free for all\nuses. But not,\nhere"), ("b", "free for all uses")], sentences=known, rules=named)
    assert got["a"]["licenses"] == ["Mine"] and got["b"]["licenses"] == ["Other"]
    with pytest.raises(ValueError):
        licenses.sentence_table(sentences, rules, most=1)


def test_readings_equal_sql(spark, tmp_path):
    """Known sentences cut and wrapped at random between headings, marks and blank lines."""
    draw, known = random.Random(5), list(licenses.SENTENCES.values())
    between = ["\n", "\n\n", "\r\n", "\r", ". ", ".\n", ": ", "  ", "(c) 2020 Foo\n", "© Foo\n", "Copyright (c) X\n", "MIT License\n", "License (2.0)\n",
               "all rights reserved\n", "# ", "\n// ", "\n----\n", "v. 2.0", "words here ", "a b c License\n", "Copyright [yyyy]\n", "-- (c) z\n", "\x01", "\n\x02"]
    rows = []
    for n in range(1500):
        text = ""
        for _ in range(draw.randint(1, 6)):
            s = draw.choice(known).split(" ")
            k = draw.randint(0, len(s))
            text += " ".join(s[:k]) + draw.choice(between) + " ".join(s[k:]) + draw.choice([".", "\n", " ", ". ", ""]) + draw.choice([*between, ""])
        rows.append((n, text))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    df.write.parquet(str(tmp_path / "documents"))
    line = lambda c: F.array_join(F.array_sort(c), " ")
    found = licenses.scan_licenses(df).select("doc_id", line("sentence_ids").alias("sentence_ids"), line("licenses").alias("licenses"))
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    wanted = {r[0]: r for r in db.execute(licenses.oracle()).fetchall()}
    got = {r["doc_id"]: tuple(r) for r in found.collect()}
    assert [i for i, _ in rows if got[i] != wanted[i]] == []
    assert sum(bool(r[2]) for r in got.values()) > 100
