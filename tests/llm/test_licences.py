import math

import pytest
from pyspark.sql import functions as F

from lakeops.llm import licences, queries

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
       "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
       "limitation the rights to use.")


@pytest.fixture(scope="module")
def texts(spark):
    plain = "Morning light came over the hills. Nobody saw it, as all were asleep.\nThe end of the day was calm."
    rows = [(i, f"{plain} Number {i} of many.") for i in range(60)] + [
        (100, plain + "\nReleased under the MIT License."), (101, "LICENSED under the Apache License, Version 2.0."),
        (102, "Some words first. This work is licensed under the GNU General Public License, version 3. More words."),
        (103, "Licensed under CC BY-NC 4.0.\nfoo\nReleased under the MIT License."), (104, MIT),
        (105, "My driving license was lost at the station yesterday.\nNo permission was given to anybody at all."),
        (106, None), (107, ""), (108, "Licensed under CC BY 4.0."), (109, "Licensed under CC BY-SA 4.0."),
        (110, "word " * 50_000 + "\nReleased under the MIT License."), (101, "LICENSED under the Apache License, Version 2.0."),
        (None, "Released under the MIT License."), (None, None)]
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                                 "doc_id long, text string, family string, paragraph int")


def test_families_of_notices(texts):
    rows = licences.report(texts).collect()
    assert len(rows) == texts.count()
    got = {r.doc_id: (r.families, r.n_notices, r.n_unknown) for r in rows}
    assert got[100] == ("mit", 1, 0) and got[102] == ("gpl", 1, 0) and got[103] == ("cc-by-nc,mit", 2, 0)
    assert got[101] == ("apache", 1, 0)  # a repeated row counts once
    assert got[104] == ("mit", 1, 0) and got[108] == ("cc-by", 1, 0) and got[109] == ("cc-by-sa", 1, 0)
    assert got[105] == ("", 0, 2) and got[106] == got[107] == ("", 0, 0)
    assert got[110] == got[None] == ("mit", 1, 0)
    assert all(got[i] == ("", 0, 0) for i in range(60))


def test_empty_table(texts):
    assert licences.report(texts.limit(0)).collect() == []


def test_every_template_is_confirmed_as_its_family(spark):
    rows = [(i, t, f) for i, (f, t) in enumerate(licences.wordings())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, want string")
    got = {r.doc_id: r.families for r in licences.report(docs).collect()}
    assert got == {i: f for i, _, f in rows}


NOTICES = [
    ("MIT License", "mit"), ("The MIT License (MIT)", "mit"), ("# SPDX-License-Identifier: MIT", "mit"),
    ("This code is licensed under MIT.", "mit"), ("Please see the file. It is free to use under the MIT License.", "mit"),
    ("Apache License 2.0", "apache"), ("// SPDX-License-Identifier: Apache-2.0", "apache"),
    ("The project is available under the Apache License, Version 2.0 since last year.", "apache"),
    ("All of the code in this folder is released under the GNU General\nPublic License, for everybody.", "gpl"),
    (" * This program is free software: you can redistribute it\n * and/or modify it under the terms of the GNU\n"
     " * general public license as published by the\n * free software foundation.", "gpl"),
    ("SPDX-License-Identifier: GPL-3.0-or-later", "gpl"), ("SPDX-License-Identifier: LGPL-2.1-only", "lgpl"),
    ("You may use it under the GNU Lesser General Public License.", "lgpl"), ("License: BSD-3-Clause", "bsd"),
    ("Distributed under the BSD 2-Clause License", "bsd"), ("SPDX-License-Identifier: CC-BY-SA-4.0", "cc-by-sa"),
    ("SPDX-License-Identifier: CC-BY-4.0", "cc-by"), ("SPDX-License-Identifier: MPL-2.0", "mpl"),
    ("SPDX-License-Identifier: CC0-1.0", "public-domain"),
    ("SPDX-License-Identifier: EPL-2.0", ""), ("My driving license was lost at the station.", ""),
    ("The licence of the new tavern on the hill was taken away by the court.", ""), ("Mit dem Zug nach Hause.", "")]


def test_notices_as_people_write_them(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string")
    got = {r.doc_id: r.families for r in licences.report(docs).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(NOTICES)] == NOTICES


def test_wrapped_lines_are_one_paragraph(spark):
    docs = spark.createDataFrame([("One line goes\non here.\nAnother\n\nList,\n  - Item",)], "text string")
    assert docs.select(licences._lines()).first()[0] == ["One line goes on here.", "Another", "", "List,", "  - Item"]


def test_scan_of_the_given_table(spark, tiny):
    known = {"gpl": "gnu general public", "cc-by-nc": "cc by-nc", "mit": "mit license", "apache": "apache license"}
    texts = {r.doc_id: r.text.lower() for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    for r in queries.QUERIES["op4_license_scan"](spark, tiny).collect():
        assert r.families == ",".join(sorted(f for f, words in known.items() if words in texts[r.doc_id]))


def test_scan_uses_no_python(spark, texts):
    plan = licences.report(texts)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_ordinary_sentences_of_all_documents_teach(spark):
    like = "You may not use this file except in compliance with number"
    plain = [(i, f"The {i} mills stood still.\nAll was calm on day {i}.") for i in range(3000)]
    ids = spark.createDataFrame(plain, "key long, text string")
    # Those that a choice of a few hundred documents by the hash of their keys leaves out.
    last = {r.key for r in ids.orderBy(F.xxhash64("key").desc()).limit(2000).collect()}
    texts = spark.createDataFrame([(i, f"{like} {i}." if i in last else t) for i, t in plain], "key long, text string")
    model = licences.train(texts)
    assert model.taught + model.held == 2000 + 2 * 1000 and min(model.taught, model.held) > 1800
    asked = licences._with_grams(spark.createDataFrame([(f"{like} five.",)], "piece string"))
    scored = model.classifier.transform(model.counter.transform(asked))
    assert scored.select(licences._licence_probability()).first()[0] < 0.5


def test_threshold_is_exact(spark):
    scores = [i / 1000 for i in range(1000)]
    held = spark.createDataFrame([(p, 1 + i % 3) for i, p in enumerate(scores)] * 2, "probability double, held long")
    plain = sorted(p for i, p in enumerate(scores) for _ in range(2 * (1 + i % 3)))
    assert licences._threshold(held) == plain[math.ceil(licences.QUIET * len(plain)) - 1]
    assert licences._threshold(held.filter("probability < 0.4")) == licences._threshold(held.limit(0)) == 0.5


def test_features_of_known_words_alone_are_the_same(spark):
    counter = licences._counter(licences.templates(spark))
    known = [g for g in counter.vocabulary if " " not in g]
    pieces = spark.createDataFrame([(t,) for _, t in licences.wordings()] + [(t,) for t, _ in NOTICES] + [
        ("is",), ("zebra",), ("The software zebra is distributed under the old License",)], "piece string")
    full, some = (counter.transform(licences._with_grams(pieces, k)).select("piece", "features").collect() for k in (None, known))
    assert sorted(map(str, full)) == sorted(map(str, some))
