import math
import random
from collections import Counter

import duckdb
import pytest
from cases import LABELS, docs, empty, prose, rows_of
from fieldmart.llm import decontaminate, licences, quality_rules, queries
from fieldmart.llm.license_texts import known
from oracle_compare import differences
from pyspark.sql import functions as F

ITEMS = "item_id long, text string"


def plain_contamination(texts, items, size=13):
    windows = [(str(i), w) for i, t in items if i is not None for w in decontaminate.windows_of(decontaminate.words_of((t or "").encode()), size)]
    for text in texts:
        words, hit, names = decontaminate.words_of((text or "").encode()), set(), set()
        for name, window in windows:
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at: at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    names.add(name)
        yield len(words), len(hit), len(names), ",".join(sorted(names))


@pytest.mark.parametrize("block", [decontaminate.BLOCK_WORDS, 40])
def test_contamination_as_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    rng = random.Random(4)
    frame = docs(spark)
    long = max((r.text or "" for r in frame.collect()), key=len).split()
    items = [(1, " ".join(long[30:60])), (2, prose(rng, 20)), (10, "two words"), (3, None), (4, "!!"), (None, "one"), (5, "One"), (5, " ".join(long[200:214])),
             (6, " ".join(long[30:43])), (7, "of " * 15), (8, "日本語")]
    expected = []
    for r, (n, hit, k, names) in zip(frame.collect(), plain_contamination([r.text for r in frame.collect()], items)):
        expected.append((r.doc_id, n, hit, k, __import__("hashlib").sha256(names.encode()).hexdigest(), hit > 0 and 20 * hit >= n))
    found = decontaminate.contamination(frame, spark.createDataFrame(items, ITEMS))
    assert rows_of(found, *found.columns) == sorted(expected, key=repr)


def test_contamination_of_nothing(spark):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(empty(spark), none).count() == 0
    assert decontaminate.contamination(docs(spark), none).filter("contaminated OR n_hit > 0 OR n_items > 0").count() == 0


def test_licences(spark):
    mit = dict((n, t) for n, t in reversed(known()) if n == "MIT")
    texts = [None, "", "Copyright (c) 2020 A\n(c) B", mit["MIT"], "Copyright 2021 Somebody\n\n" + mit["MIT"].upper().replace(",", " , "),
             "some text\nReleased under the MIT Licence!\nLicensed under CC BY-NC 4.0", "Licensed under the Apache License, Version 2.0 and more"]
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lines string")
    found = {r.doc_id: (r.n_lines, r.license_id, r.notices) for r in licences.licence_scan(frame.union(frame.limit(2))).collect()}
    assert found[0] == found[1] == found[2] == (0, None, "")
    assert found[3][1] == found[4][1] == "MIT"
    assert found[5] == (3, None, "CC-BY-NC-4.0,MIT") and found[6] == (1, None, "")
    assert licences.licence_scan(empty(spark)).count() == 0
    assert Counter(r.doc_id for r in licences.licence_scan(docs(spark)).collect()) == Counter(r.doc_id for r in docs(spark).collect())  # repeated rows, too


def test_punctuation_of_any_script_and_holders_alone(spark, tmp_path):
    """Forms in which the MIT text is met, and the same rule in SQL."""
    curly = MIT_WRAPPED.replace('"Software"', "\u201cSoftware\u201d").replace('"AS IS"', "\u00abAS IS\u00bb").replace("-", "\u2013")
    forms = [curly, MIT_WRAPPED.replace(" ", "\u00a0", 40), "\ufeff" + MIT_WRAPPED, "\u200b" + MIT_WRAPPED.replace(",", "\u3001"),
             "Copyright Some Body\n" + MIT_WRAPPED, "Copyright by The Some Body and Friends\n" + MIT_WRAPPED, "  # COPYRIGHT Ærø Ltd\n" + MIT_WRAPPED]
    rows = [(i, t) for i, t in enumerate(forms)] + [(None, "Copyright Licence Terms apply"), (None, "Copyright Licence Terms apply"), (90, "x " * 300_000 + MIT_WRAPPED)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = licences.licence_scan(frame)
    assert {r.doc_id: r.license_id for r in found.collect()} == {**{i: "MIT" for i in range(len(forms))}, None: None, 90: None}
    assert found.filter("doc_id IS NULL AND n_lines = 1").count() == 2
    frame.coalesce(1).write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert differences(found, con, queries.SQL["op3_licences"]) == []


MIT_WRAPPED = """MIT License

Copyright (c) 2020 Some Body

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
ISC_WRAPPED = """ISC License

Copyright (c) 2004-2010 by Internet Systems Consortium, Inc. ("ISC")
Copyright (c) 1995-2003 by Internet Software Consortium

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF
OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""


def test_licences_in_any_wrapping(spark):
    wrapped = {"MIT": MIT_WRAPPED, "ISC": ISC_WRAPPED}
    unsigned = {n: "\n".join(line for line in t.split("\n") if not line.startswith("Copyright")) for n, t in wrapped.items()}
    forms = [(n, f(t)) for of in (wrapped, unsigned) for n, t in of.items() for f in (str, str.upper, lambda t: " ".join(t.split()))]
    forms += [(n, "\n".join(t.split())) for n, t in unsigned.items()]
    found = licences.licence_scan(spark.createDataFrame(enumerate(t for _, t in forms), "doc_id long, text string"))
    assert {r.doc_id: r.license_id for r in found.collect()} == {i: n for i, (n, _) in enumerate(forms)}
    assert found.select("text_sha256").distinct().count() == 2


def test_only_copyright_statements_are_dropped(spark):
    gone = ["Copyright 2021 Somebody", "# Copyright (C) 2020, A. All rights reserved.", "© A", "(c) 2020 a", "(c) Acme Corp.", "All rights reserved.",
            "Copyright <YEAR> <COPYRIGHT HOLDER>", "Copyright Joyent, Inc. and other Node contributors."]
    kept = ["copyright law is long", "COPYRIGHT HOLDERS AND CONTRIBUTORS BE LIABLE", "copyright notice and this list", "Copyright License. Subject to the authors",
            "(c) You must retain, in the Source form", "all rights reserved in this work stay", "copyrighted works"]
    rows = spark.createDataFrame(enumerate(gone + kept), "doc_id long, text string")
    found = {r.doc_id: r.n_lines for r in licences.licence_scan(rows).collect()}
    assert [found[i] for i in range(len(found))] == [0] * len(gone) + [1] * len(kept)


def test_whole_licences(spark):
    from pathlib import Path

    whole = {f.stem: f.read_text() for f in sorted((Path(licences.__file__).parent / "spdx").iterdir())}
    assert len(whole) >= 18 and {"Apache-2.0", "GPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "Unlicense", "Zlib", "CC0-1.0"} <= set(whole)
    texts = [*whole.items(), ("Apache-2.0", whole["Apache-2.0"].split("END OF TERMS")[0]), ("MIT", "The MIT License (MIT)\n" + MIT_WRAPPED.split("\n", 1)[1]),
             ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, A\nAll rights reserved.\n\n" + whole["BSD-3-Clause"].replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* "))]
    found = licences.licence_scan(spark.createDataFrame(enumerate(t for _, t in texts), "doc_id long, text string"))
    assert {r.doc_id: r.license_id for r in found.collect()} == {i: n for i, (n, _) in enumerate(texts)}


def test_any_number_of_licences(spark):
    names = [f"L-{i:03}" for i in range(200)]
    frame = spark.createDataFrame([(1, "\n".join(f"line of {n}" for n in reversed(names)))], "doc_id long, text string")
    assert licences.licence_scan(frame, texts=[(n, f"line of {n}") for n in names]).first().notices == ",".join(names)


def plain_measures(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if line.encode().split()]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), n < 10 or 100 * len(covered) > 20 * n)


def test_measures(spark):
    frame = docs(spark)
    expected = sorted(((r.doc_id, *plain_measures(r.text)) for r in frame.collect()), key=repr)
    found = quality_rules.measures(frame)
    assert rows_of(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == expected


def test_binomial_tail_is_exact(spark):
    cases = [(n, k) for n in (1, 30, 400, 3000) for k in (0, 1, 2, 7, 25) if k < n]
    rows = spark.createDataFrame(cases, "n long, k long").select("n", "k", F.exp(quality_rules._log_tail(F.col("n"), F.col("k"), 0.01)).alias("p")).collect()
    for r in rows:
        exact = 1.0 if r.k >= r.n * 0.01 else sum(math.comb(r.n, j) * 0.01**j * 0.99 ** (r.n - j) for j in range(r.k + 1))
        assert r.p == pytest.approx(exact, rel=1e-9)


def test_a_hundred_labels_certify_a_cutoff_and_the_bound_holds(spark):
    """Of many draws with a true rate of false rejection over the risk, few get a cutoff that lets it through."""
    rng, rows, true = random.Random(12), [], {}
    for stratum in range(60):
        for i in range(150):
            rows.append((stratum, i, 100 if rng.random() < 0.05 else 0))  # one good text in twenty has this share of symbols
    frame = spark.createDataFrame([(f"s{s}", 1000, n * 1, 0, 0, 100, 0, 10) for s, i, n in rows],
                                  "stratum string, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_words long, n_capitals long, n_lines long")
    bad = frame.withColumns({"n_symbols": F.lit(60).cast("long"), "good": F.lit(False)})  # only a cutoff below 60 would catch them
    marked = frame.withColumn("good", F.lit(True)).union(bad)
    found = {r.stratum: r.cutoff for r in quality_rules.cutoffs(marked, risk=0.04, doubt=0.05).collect()}
    assert len(found) == 60 and sum(c is not None and c < 100 for c in found.values()) <= 1
    clean = frame.withColumn("n_symbols", F.lit(0).cast("long")).filter("stratum < 's12'")
    n = clean.select("stratum").distinct().count()
    least = math.ceil(math.log(0.05 / n) / math.log(1 - 0.04))
    clean = clean.withColumn("good", F.lit(True)).union(bad.join(clean.select("stratum").distinct(), "stratum", "left_semi"))
    enough = {r.stratum: r.cutoff for r in quality_rules.cutoffs(clean).collect()}
    assert least < 150 and set(enough.values()) == {50}  # the loosest that catches the bad ones
    few = clean.groupBy("stratum", "good").agg(*[F.min(c).alias(c) for c in clean.columns if c not in ("stratum", "good")])
    assert {r.cutoff for r in quality_rules.cutoffs(few).collect()} == {None}


def test_cutoffs_spare_good_texts(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, 30) + (" ###" * 30 if i % 7 == 0 else ""), "en" if i < 1500 else "fr") for i in range(1600)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 7 != 0), 0) for i in range(1600)] + [(None, 1, 0), (3, None, 0)], LABELS)
    found = {r.doc_id: r for r in quality_rules.judged(frame, labels).collect()}
    base = {i for i, r in found.items() if not r.base_failed}
    assert all(found[i].kept == (i % 7 != 0) for i in base if i < 1500)
    assert all(found[i].kept for i in base if i >= 1500)  # 85 good labels are too few to be sure
    assert quality_rules.judged(empty(spark), labels).count() == 0
    assert quality_rules.judged(docs(spark), labels.limit(0)).filter("kept = base_failed").count() == 0
