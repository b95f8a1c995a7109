from dataclasses import replace

from pyspark.sql import functions as F

GPL = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
       "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.")


def brute(model, templates, text, confirm=0.8, span=96):
    """Families, number and best score of a text's licence paragraphs, by loops over every window of every block."""
    import math
    import re

    from strongroom.llm.licences import SPDX

    def words(t):
        return re.findall(r"[a-z0-9]+(?:[.-][a-z0-9]+)*", t.lower())

    def pairs(w):
        return {f"{a} {b}" for a, b in zip(w, w[1:])}

    sets = [(f, pairs(words(t))) for f, t in templates]

    def sure(family, held):
        return any(f == family and len(t & held) >= confirm * len(t)
                   and all(len((t - u) & held) >= confirm * len(t - u) for g, u in sets if g != f and 2 * len(t & u) >= len(t) and t - u) for f, t in sets)

    families, best, n = set(), 0.0, 0
    for block in re.split(r"\r?\n(?:[^\S\n]*\n)+", text or "", flags=re.A):
        found = {}
        for line in re.findall(r"(?i)spdx-license-identifier:([^\n]*)", block):
            for name in re.findall(r"[a-z0-9][a-z0-9.+-]*", line.lower()):
                fits = [k for k in SPDX if name.startswith(k) and (k.endswith("-") or not name[len(k) : len(k) + 1].isalnum())]
                if fits:
                    found[SPDX[max(fits, key=len)]] = 1.0
        w = words(block)
        for k in range(0, max(1, -(-len(w) // span) - 1)):
            held = pairs(w[k * span : (k + 2) * span]) & set(model.weights)
            for c, family in enumerate(model.classes):
                score = 1 / (1 + math.exp(-(model.intercepts[c] + sum(model.weights[p][c] for p in held))))
                if score >= model.threshold and sure(family, held):
                    found[family] = max(score, found.get(family, 0))
        families |= set(found)
        best, n = max([best, *found.values()]), n + bool(found)
    return ",".join(sorted(families)), n, best


def test_licences_equal_brute_force_on_whole_documents(spark):
    """All of sf0.01, and notices with words dropped, doubled, exchanged, denied, wrapped and mixed into prose."""
    import random

    from strongroom.llm.licences import NOTICES, fit, scan_paragraphs

    rnd = random.Random(3)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    model = fit(docs)
    broken = []
    for k in range(500):
        words = rnd.choice(NOTICES)[1].split(" ")
        for _ in range(rnd.randint(0, 5)):
            i = rnd.randrange(len(words))
            words[i : i + 1] = rnd.choice([[], [words[i]] * 2, [rnd.choice(rnd.choice(NOTICES)[1].split(" "))], [words[i].upper()], ["not", words[i]], [words[i] + "\n"]])
            words = words or ["x"]
        before = "prose of the house " * rnd.choice([0, 1, 30, 70])
        broken.append((-k - 1, before + rnd.choice(["", "\n\n", " \r\n\t\n"]) + " ".join(words) + rnd.choice(["", "\n" + rnd.choice(NOTICES)[1], " and more", "\n\n" + GPL])))
    docs = docs.unionByName(spark.createDataFrame(broken, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = scan_paragraphs(docs, model).collect()
    assert len(got) == len(texts)
    for r in got:
        families, n, best = brute(model, NOTICES, texts[r.doc_id])
        assert (r.families, r.n_paragraphs) == (families, n), texts[r.doc_id][:300]
        assert abs(r.score - best) < 1e-9
    assert sum(r.n_paragraphs > 0 for r in got if r.doc_id < 0) > 250
    # Every planted notice of the table is found: a document that speaks of a licence has a family.
    said = {k for k, t in texts.items() if k >= 0 and t and "licensed under" in t.lower()}
    assert said and all(r.families for r in got if r.doc_id in said)


def test_the_classifier_decides(spark):
    """Denied notices hold all of a template; only the regressions tell them, so without them the rows change."""
    from strongroom.llm.licences import scan_paragraphs, train

    denied = ["This code is not released under the MIT License.", "It was never licensed under the Apache License, Version 2.0.", "not released under the MIT License at all",
              "This work is no longer licensed under the GNU General Public License, version 3."]
    said = [t.replace("not ", "").replace("never ", "").replace("no longer ", "") for t in denied]
    df = spark.createDataFrame(list(enumerate(denied + said)), "doc_id long, text string")
    model = train()
    got = {r.doc_id: r.families for r in scan_paragraphs(df, model).collect()}
    assert [got[k] for k in range(8)] == ["", "", "", "", "mit", "apache-2.0", "mit", "gpl-3.0"]
    off = {r.doc_id: r.families for r in scan_paragraphs(df, replace(model, threshold=0.0)).collect()}
    assert [off[k] for k in range(4)] == ["mit", "apache-2.0", "mit", "gpl-3.0"]
    # Weights exchanged between families name others, and no template confirms those.
    turned = replace(model, weights={p: w[1:] + w[:1] for p, w in model.weights.items()})
    assert not any(r.families for r in scan_paragraphs(df, turned).collect())


def test_unknown_is_calibrated_on_paragraphs_of_the_corpus(spark):
    from strongroom.llm.licences import fit, train

    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fit(empty).threshold == train().threshold
    # Paragraphs that speak of software and rights without a notice, each of its own words.
    some = ["redistribute it", "the software", "of the license", "under the terms", "public license", "free software", "to use copy", "copyright notice and", "version 3", "the mit", "this software is", "rights to use"]
    rows = [(k, " and ".join([some[k % 12], f"word{k}", some[k // 12 % 12], "a house", some[k // 144 % 12]])) for k in range(1728)] + [(None, None), (1, ""), (1, "x")]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string").withColumn("_held", F.lit(1)), train_rows=300)
    base = train()
    assert model.weights != base.weights
    loud = lambda m: sum(brute_score(m, t) >= m.threshold for _, t in rows if t)
    assert loud(model) <= 0.01 * len(rows)
    assert base.threshold <= model.threshold <= max(0.5, model.reach) and model.reach > 0.3


def brute_score(model, text):
    import math

    from strongroom.llm.licences import pairs, words_of

    held = pairs(words_of(text)) & set(model.weights)
    return max(1 / (1 + math.exp(-(b + sum(model.weights[p][k] for p in held)))) for k, b in enumerate(model.intercepts))


def test_wrapped_notices_and_every_family_of_a_paragraph(spark):
    from strongroom.llm.licences import NOTICES, scan_paragraphs, train

    bsd = " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:"
    isc = "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies."
    prose = "a house by the sea and the public garden of the town " * 40
    cases = [
        (bsd, "bsd", 1), (GPL, "gpl-3.0", 1), (GPL.replace("version 3", "version 2"), "gpl-2.0", 1), (GPL.replace("GNU General", "GNU Affero General"), "agpl-3.0", 1),
        (GPL.replace("GNU General", "GNU Lesser General"), "lgpl", 1), (isc, "isc", 1), (prose + GPL + prose + isc + prose, "gpl-3.0,isc", 1), (f"{prose}\n\n{bsd}\n \n{GPL}\r\n\r\n{prose}", "bsd,gpl-3.0", 2),
        ("Released under the MIT License. Licensed under CC BY-NC 4.0.", "cc-by-nc,mit", 1), ("// SPDX-License-Identifier: (GPL-2.0-or-later OR MIT)", "gpl-2.0,mit", 1),
        ("This is free and unencumbered software released into the\npublic domain.", "unlicense", 1), (prose, "", 0), ("", "", 0), (None, "", 0), ("mit\ngnu general public license", "", 0),
        ("x\nALL Rights Reserved. And more", "proprietary", 1), ("under the GNU house", "", 0), (prose * 300 + GPL, "gpl-3.0", 1),
        ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.", "mit", 1),
    ]
    for f, t in NOTICES:
        # The first Eclipse notice starts with a rights line of its own; some name two licences.
        both = {"epl-1.0": "epl-1.0,proprietary"}.get(f, f) if "MIT" not in t or f not in ("mit", "apache-2.0") or "Apache" not in t else "apache-2.0,mit"
        cases.append((t.replace(", ", ",\n"), both, 1))
    cases.append(cases[0])  # a repeated row
    df = spark.createDataFrame([(k, t, 1.0, "x") for k, (t, _, _) in enumerate(cases)], "doc_id long, text string, score double, families string")
    model = train()
    out = scan_paragraphs(df, model)
    got = {r.doc_id: r for r in out.collect()}
    for k, (t, families, n) in enumerate(cases):
        assert (got[k].families, got[k].n_paragraphs) == (families, n), (t, got[k])
    assert scan_paragraphs(df.limit(0), model).count() == 0
    assert scan_paragraphs(df.union(df).withColumn("doc_id", F.lit(None).cast("long")), model).count() == 2 * len(cases)
    plan = out._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_every_paragraph_of_the_corpus_trains_and_calibrates(spark):
    """More different paragraphs than are trained on at once: the loss over all of one half is at its least, the threshold is that of all windows of the other half."""
    import numpy as np

    from strongroom.llm.licences import NOTICES, PENALTY, by_template, examples_of, fit, pairs, paragraphs, train, vocabulary_of, words_of

    known = sorted(p for p in vocabulary_of(NOTICES) if p.replace(" ", "").isalpha())[::9][:40]
    text = lambda k: " zz ".join([known[k % 40], known[k * 7 // 40 % 40], known[k // 3 % 40]])
    docs = spark.createDataFrame([(k, text(k)) for k in range(2400)] + [(k, text(k % 5)) for k in range(10_000)], "doc_id long, text string")
    found = [(r["_held"], r["_n"], r["h"] % 2) for r in paragraphs(docs).withColumn("h", F.xxhash64("_held")).collect()]
    shapes = [s for _, s, _ in by_template(NOTICES)]
    counted = lambda held: len(held) > 1 and not any(2 * len(s & held) >= len(s) for s in shapes)
    assert sum(n for _, n, _ in found) == sum(counted(pairs(words_of(text(k))) & set(vocabulary_of(NOTICES))) for k in [*range(2400), *(k % 5 for k in range(10_000))])
    half = [h for h, _, odd in found if not odd]
    assert len(half) > 100
    model, old = fit(docs, train_rows=20), train(unknown=half[:20])

    vocabulary = vocabulary_of(NOTICES)
    rows = [(labels, held, 1.0) for labels, held in examples_of(NOTICES)] + [(set(), set(h), 20 / len(half)) for h in half]
    x, y = np.zeros((len(rows), len(vocabulary) + 1)), np.zeros((len(rows), len(model.classes)))
    x[:, -1] = 1
    for k, (labels, held, _) in enumerate(rows):
        x[k, [vocabulary[p] for p in held if p in vocabulary]] = 1
        y[k, [model.classes.index(f) for f in labels]] = 1
    share = np.array([w for _, _, w in rows])[:, None] / sum(w for _, _, w in rows)

    def loss(m):
        w = np.array([*[m.weights[p] for p in vocabulary], m.intercepts])
        z = x @ w
        slope = x.T @ (share * (1 / (1 + np.exp(-z)) - y))
        slope[:-1] += PENALTY * w[:-1]
        return (share * (np.logaddexp(0, z) - y * z)).sum() + PENALTY / 2 * (w[:-1] ** 2).sum(), np.abs(slope).max()

    assert loss(model)[0] < loss(old)[0] and loss(model)[1] < 1e-3
    # The alarm: no more than a share of 0.001 of all windows of the other half passes, unless changed notices need a lower threshold.
    other = [(max(1 / (1 + np.exp(-(b + sum(model.weights[p][c] for p in h)))) for c, b in enumerate(model.intercepts)), n) for h, n, odd in found if odd]
    loud = sum(n for s, n in other if s > model.threshold)
    assert loud <= 0.001 * sum(n for _, n in other) or model.threshold == max(0.5, model.reach)


def test_one_regression_is_fit_after_the_other(spark, monkeypatch):
    """Several at once fill the driver's heap; every family still gets its own regression over all rows, in as many tasks as the rows need."""
    import time

    from pyspark.ml.classification import LogisticRegression

    from strongroom.llm.licences import TEMPLATES, families_of, pairs, train_spread, words_of

    fit, running, most, n_rows, n_tasks = LogisticRegression.fit, [], [], [], []

    def watched(self, data, params=None):
        running.append(1)
        most.append(len(running))
        n_rows.append(data.count())
        n_tasks.append(data.rdd.getNumPartitions())
        time.sleep(0.2)
        try:
            return fit(self, data, params)
        finally:
            running.pop()

    monkeypatch.setattr(LogisticRegression, "fit", watched)
    frame = type(spark.range(0))
    wider = lambda self, n, *cols, f=frame.repartition: f(self, max(n, 30), *cols)
    monkeypatch.setattr(frame, "repartition", wider)
    templates = [t for t in TEMPLATES if t[0] in ("mit", "bsd", "cc0", "mpl-2.0")]
    unknown = spark.createDataFrame([(sorted(pairs(words_of(f"of this software word{k} in source"))),) for k in range(60)], "_held array<string>")
    model = train_spread(unknown, 60, 0.5, templates, steps=5)
    assert model.classes == families_of(templates) and len(most) == len(model.classes) == 4
    assert max(most) == 1 and max(n_tasks) == 1
    assert len(set(n_rows)) == 1 and n_rows[0] > 60
    # The weights tell the families apart: each notice scores highest in its own.
    for family, text in templates:
        held = pairs(words_of(text))
        scores = [b + sum(model.weights[p][c] for p in held) for c, b in enumerate(model.intercepts)]
        assert model.classes[scores.index(max(scores))] == family


def test_windows_equal_slices_of_words(spark):
    import random

    from strongroom.llm.licences import windows

    rnd, known, span = random.Random(5), ["a b", "b c", "c a"], 4
    lists = [[rnd.choice("abcd") for _ in range(n)] for n in range(30) for _ in range(3)]
    got = spark.createDataFrame([(k, w) for k, w in enumerate(lists)], "k int, words array<string>").select("k", F.expr(windows("words", known, span)).alias("w")).collect()
    for r in got:
        w = lists[r.k]
        want = []
        for k in range(max(1, -(-len(w) // span) - 1)):
            cut = w[k * span : (k + 2) * span]
            want.append(list(dict.fromkeys(p for p in (f"{a} {b}" for a, b in zip(cut, cut[1:])) if p in known)))
        assert r.w == want
