"""Licence scans: a trained paragraph classifier confirmed by templates.

Native: texts are scored by DataFrame functions alone.  One logistic
regression per family, over the sparse word pairs of a paragraph, names its
families; a paragraph with none above the threshold is unknown.  The models
are trained on standard notices and clauses of the licences, whole, with words
missing and mixed, against fragments of them, denials (:func:`train`) and all
different paragraphs of one half of the corpus.  The threshold is calibrated on
all paragraphs of the other half and on changed notices that took no part in
the training (:func:`fit`).  A family that the classifier names counts only if a template
of it confirms it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Opening or reference lines of public licences, by family.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("mit", "Released under the MIT License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights under CC0 1.0."),
    ("proprietary", "All rights reserved."),
]
#: Standard notices and first sentences of the public texts, as they stand in files; at most 72 words each.
GNU = ("is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation, "
       "either version {} of the License, or (at your option) any later version.")
NOTICES = TEMPLATES + [
    ("gpl-3.0", "This program " + GNU.format("General", "3")),
    ("gpl-2.0", "This program " + GNU.format("General", "2")),
    ("agpl-3.0", "This program " + GNU.format("Affero General", "3")),
    ("lgpl", "This library " + GNU.format("Lesser General", "2.1")),
    ("lgpl", "This program " + GNU.format("Lesser General", "3")),
    ("gpl-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("gpl-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("agpl-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("lgpl", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("lgpl", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("agpl-3.0", "This program is licensed under the GNU Affero General Public License, version 3."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "This project is licensed under the MIT License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at"),
    ("epl-1.0", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication"),
    ("mit", "This project is MIT licensed."),
    ("mit", "Dual-licensed under MIT or Apache-2.0."),
    ("apache-2.0", "Dual-licensed under MIT or Apache-2.0."),
    ("mit", "Licensed under either of Apache License, Version 2.0 or MIT license at your option."),
    ("apache-2.0", "Licensed under either of Apache License, Version 2.0 or MIT license at your option."),
    ("bsd", "This project is licensed under the BSD 3-Clause License."),
    ("bsd", "This project is licensed under the BSD 2-Clause License."),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", "The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement."),
    ("mit", "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the Software"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", "This software is provided by the copyright holders and contributors as is and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed."),
    ("isc", "The software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness."),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("apache-2.0", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, "
                   "prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form."),
    ("gpl-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("gpl-3.0", "The licenses for most software and other practical works are designed to take away your freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee "
                "your freedom to share and change all versions of a program--to make sure it remains free software for all its users."),
    ("gpl-3.0", "Developers that use the GNU GPL protect your rights with two steps: assert copyright on the software, and offer you this License giving you legal permission to copy, distribute and/or modify it."),
    ("gpl-3.0", "This License refers to version 3 of the GNU General Public License."),
    ("gpl-2.0", "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom to share and change "
                "free software--to make sure the software is free for all its users."),
    ("agpl-3.0", "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software."),
    ("lgpl", "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below."),
    ("zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software."),
    ("zlib", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
]
#: Families of SPDX licence identifiers, by their beginning in small letters; the longest one that fits counts.
SPDX = {"apache-2.0": "apache-2.0", "gpl-3.0": "gpl-3.0", "gpl-2.0": "gpl-2.0", "lgpl-": "lgpl", "agpl-3.0": "agpl-3.0", "mit": "mit", "bsd-": "bsd", "isc": "isc", "mpl-2.0": "mpl-2.0", "epl-2.0": "epl-2.0",
        "epl-1.0": "epl-1.0", "unlicense": "unlicense", "zlib": "zlib", "cc-by-4.0": "cc-by", "cc-by-sa-": "cc-by-sa", "cc-by-nc-": "cc-by-nc", "cc0-": "cc0"}
WORDS = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
#: Weight of the squares of the regressions' weights in their loss.
PENALTY = 2e-5


def pairs(words: list[str]) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def words_of(line: str) -> list[str]:
    import re

    return re.findall(WORDS, line.lower())


def by_template(templates: list[tuple[str, str]]) -> list[tuple[str, set[str], list[set[str]]]]:
    """Per template its family, its word pairs, and the sets of pairs that tell it from each similar template of another family."""
    sets = [(f, pairs(words_of(t))) for f, t in templates]
    return [(f, t, [t - u for g, u in sets if g != f and 2 * len(t & u) >= len(t) and t - u]) for f, t in sets]


def confirmed(held: set[str], templates, confirm: float) -> set[str]:
    """Families of the templates (of :func:`by_template`) that the word pairs ``held`` confirm."""
    return {f for f, t, others in templates if all(len(d & held) >= confirm * len(d) for d in (t, *others))}


@dataclass(frozen=True)
class LicenceModel:
    """For each word pair its weight in each family's regression; families below ``threshold`` are unknown."""

    classes: tuple[str, ...]
    intercepts: tuple[float, ...]
    weights: dict[str, tuple[float, ...]]
    threshold: float
    #: The score that nearly all changed notices reach, the upper bound of a calibrated threshold if above 0.5.
    reach: float


def denials(text: str) -> list[str]:
    """Short notices turned into their contrary."""
    import re

    if len(text.split(" ")) > 16:
        return []
    at = re.search(r"(?i)\b(?:released|licensed|subject|mit licensed)\b", text)
    return [f"{text[: at.start()]}{no} {text[at.start() :]}" for no in ("not", "never", "no longer", "is not")] if at else []


def examples_of(templates: list[tuple[str, str]]) -> list[tuple[set[str], set[str]]]:
    """Families and word pairs of the examples made of the templates (a fixed, bounded set)."""
    import random

    rnd = random.Random(7)
    shapes = by_template(templates)
    lists = [words_of(t) for _, t in templates]
    told = [{f} | confirmed(t, shapes, 1.0) for f, t, _ in shapes]
    examples: list[tuple[set[str], set[str]]] = [(set(), set())] * 20
    for (family, text), w, labels in zip(templates, lists, told):
        step = max(1, len(w) // 12)
        examples += [(labels, pairs(w))] * 4 + [(labels, pairs(w[:k] + w[k + 1 :])) for k in range(0, len(w), step) if len(w) > 6]
        examples += [(set(), pairs(w[k : k + 3])) for k in range(0, len(w) - 3, max(step, 3)) if len(w) > 12]
        examples += [(set(), pairs(words_of(d))) for d in denials(text)]
    for k in range(8 * len(lists)):
        several = [k % len(lists), *rnd.sample(range(len(lists)), 1 + k % 2)]
        examples.append((set().union(*[told[i] for i in several]), set().union(*[shapes[i][1] for i in several])))
    return examples


def vocabulary_of(templates: list[tuple[str, str]]) -> dict[str, int]:
    """The known word pairs, those of the templates and of their denials, with their numbers."""
    return {p: k for k, p in enumerate(sorted(set().union(*[pairs(words_of(t)) for _, t in templates], *[pairs(words_of(d)) for _, t in templates for d in denials(t)])))}


def families_of(templates: list[tuple[str, str]]) -> tuple[str, ...]:
    return tuple(dict.fromkeys(f for f, _ in templates))


def model_of(templates: list[tuple[str, str]], weights, confirm: float) -> LicenceModel:
    """The model of a matrix of weights: a row per known word pair and one of intercepts, a column per family."""
    classes, vocabulary = families_of(templates), vocabulary_of(templates)
    reach = changed_notices(templates, by_template(templates), [words_of(t) for _, t in templates], classes, vocabulary, weights, confirm)
    return LicenceModel(classes, tuple(float(f"{w:.6g}") for w in weights[-1]), {p: tuple(float(f"{w:.6g}") for w in weights[k]) for p, k in vocabulary.items()}, min(0.5, reach), reach)


def train(templates: list[tuple[str, str]] = NOTICES, unknown: list[list[str]] = (), penalty: float = PENALTY, steps: int = 300, confirm: float = 0.8) -> LicenceModel:
    """Fit on the templates (a fixed, bounded set) and ``unknown``, word pairs of paragraphs without a licence.

    A template is given whole, without each of about twelve of its words, and
    together with one or two of other families, whose labels it then has too.
    No family have its short pieces, its denials and ``unknown``.  The
    threshold is 0.5, or less if changed notices that took no part need it.
    """
    import numpy as np

    classes, vocabulary = families_of(templates), vocabulary_of(templates)
    own = examples_of(templates)
    examples = own[:20] + [(set(), set(u)) for u in unknown] + own[20:]
    x = np.zeros((len(examples), len(vocabulary) + 1), dtype=np.float32)
    truth = np.zeros((len(examples), len(classes)), dtype=np.float32)
    x[:, -1] = 1  # the intercept
    for row, mark, (labels, held) in zip(x, truth, examples):
        row[[vocabulary[p] for p in held if p in vocabulary]] = 1
        mark[[classes.index(f) for f in labels]] = 1
    # Nesterov steps of the penalised logistic loss, by its greatest curvature (power iteration).
    v = np.ones(x.shape[1], dtype=np.float32)
    for _ in range(20):
        v = x.T @ (x @ v)
        v /= np.linalg.norm(v)
    rate = 1 / (0.25 * float(np.linalg.norm(x @ v)) ** 2 / len(x) + penalty)
    weights = ahead = np.zeros((x.shape[1], len(classes)), dtype=np.float32)
    for k in range(steps):
        slope = x.T @ (1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30))) - truth) / len(x)
        slope[:-1] += penalty * ahead[:-1]
        after = ahead - rate * slope
        ahead, weights = after + k / (k + 3) * (after - weights), after
    return model_of(templates, weights, confirm)


def train_spread(unknown: DataFrame, n_unknown: int, share: float, templates: list[tuple[str, str]] = NOTICES, penalty: float = PENALTY, confirm: float = 0.8,
                 steps: int = 40, task_rows: int = 50_000) -> LicenceModel:
    """As :func:`train`, with all ``n_unknown`` rows of ``unknown`` (``_held``), which lie in Spark and weigh ``share`` each.

    The same penalised loss, minimised by MLlib over one cached table.  One
    regression is fit after the other: each is about 45 jobs, and those of
    several at once fill the driver's heap, whatever the size of the input."""
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import CountVectorizerModel

    spark = unknown.sparkSession
    classes, vocabulary = families_of(templates), vocabulary_of(templates)
    own = spark.createDataFrame([(sorted(held), sorted(labels), 1.0) for labels, held in examples_of(templates)], "_held array<string>, _labels array<string>, _weight double")
    rows = own.unionByName(unknown.select("_held", F.array().cast("array<string>").alias("_labels"), F.lit(share).alias("_weight")))
    # Rows of a task in a fixed order, so that sums come out alike in each run.  Every step of a regression pays for each
    # task, so there are as many as the rows need, also where shuffles are dealt out wider.
    n_tasks = -(-n_unknown // task_rows)
    rows = rows.repartition(n_tasks, "_held").coalesce(n_tasks).sortWithinPartitions("_held", "_labels")
    counts = CountVectorizerModel.from_vocabulary(list(vocabulary), "_held", "_pairs")
    data = counts.setBinary(True).transform(rows).select("_pairs", "_labels", "_weight").persist()
    regression = LogisticRegression(featuresCol="_pairs", labelCol="_label", weightCol="_weight", regParam=penalty, standardization=False, maxIter=steps, family="binomial")
    found = [regression.fit(data.withColumn("_label", F.array_contains("_labels", family).cast("double"))) for family in classes]
    weights = np.array([[*m.coefficients.toArray(), m.intercept] for m in found]).T
    data.unpersist()
    return model_of(templates, weights, confirm)


def changed_notices(templates, shapes, lists, classes, vocabulary, weights, confirm: float) -> float:
    """The score that 98 of 100 changed but still confirmed notices reach; their changes are not those of the training."""
    import random

    import numpy as np

    rnd, scores = random.Random(11), []
    for (family, _), words in zip(templates, lists):
        for _ in range(12):
            w = [rnd.choice(["x", "y"]) if rnd.random() < 0.05 else word for word in ["prose", *words, "prose"]]
            held = pairs(w)
            if family in confirmed(held, shapes, confirm):
                at = [vocabulary[p] for p in held if p in vocabulary]
                scores.append(1 / (1 + np.exp(-float(weights[at, classes.index(family)].sum() + weights[-1, classes.index(family)]))))
    return float(np.quantile(scores, 0.02))


def number(values) -> Column:
    return F.expr("array(" + ",".join(f"{float(v)!r}D" for v in values) + ")")


def texts(values) -> Column:
    """An array literal; the values have no quotes."""
    return F.expr("array(" + ",".join(f"'{v}'" for v in values) + ")")


def anchors(templates: list[tuple[str, str]], confirm: float) -> list[str]:
    """Word pairs of which every confirmed text holds at least one: more of each template than it may miss, of rare words first."""
    import math

    common = set("a an and are as at be by for in is it of on or that the this to with you".split())
    out = set()
    for _, text in templates:
        held = sorted(pairs(words_of(text)), key=lambda p: (len(common.intersection(p.split(" "))), -len(p), p))
        out.update(held[: len(held) - math.ceil(confirm * len(held)) + 1])
    return sorted(out)


def literal(templates: list[tuple[str, str]]) -> Column:
    """The templates with their families and the sets of pairs that confirm them, the first of them all of its own."""
    return F.array(*[
        F.struct(F.lit(f).alias("family"), F.array(texts(sorted(t)), *[texts(sorted(d)) for d in others]).alias("needed"))
        for f, t, others in by_template(templates)])


def windows(words: str, known: list[str], span: int) -> str:
    """Known word pairs, each once, in windows of twice ``span`` words that start every ``span`` words; SQL of an array of words and of the result.

    ``cells`` are the places of known pairs in every ``span`` words; a window has two of them but no pair that leaves it.
    They are an array's only element, so that they are made once and not for each window."""
    pair = f"concat(get({words}, i), ' ', get({words}, i + 1))"  # null at the end
    n = f"cast(ceil(size({words}) / {span}) as int)"
    among = lambda values: ",".join(f"'{v}'" for v in values)
    known_pair = f"get({words}, i) in ({among(sorted({p.split(' ')[0] for p in known}))}) and {pair} in ({among(known)})"
    cells = f"transform(sequence(0, greatest({n} - 1, 0)), c -> filter(sequence(c * {span}, (c + 1) * {span} - 1), i -> {known_pair}))"
    second = f"filter(coalesce(get(cells, k + 1), cast(array() as array<int>)), i -> i < (k + 2) * {span} - 1)"
    window = f"array_distinct(transform(concat(get(cells, k), {second}), i -> {pair}))"
    return f"get(transform(array({cells}), cells -> transform(sequence(0, greatest({n} - 2, 0)), k -> {window})), 0)"


def likelihoods(model: LicenceModel, held: Column) -> Column:
    """The logistic regressions of all families over the word pairs ``held``: an array of family and score."""
    weight = F.expr("map(" + ",".join(f"'{p}',array(" + ",".join(f"{v!r}D" for v in model.weights[p]) + ")" for p in sorted(model.weights)) + ")")
    total = F.aggregate(held, number(model.intercepts), lambda s, p: F.zip_with(s, F.element_at(weight, p), lambda x, y: x + y))
    return F.zip_with(texts(model.classes), total, lambda f, x: F.struct(f.alias("family"), (1 / (1 + F.exp(-x))).alias("score")))


BLOCKS = r"\r?\n(?:[^\S\n]*\n)+"


def paragraphs(df: DataFrame, text_col: str = "text", templates: list[tuple[str, str]] = NOTICES, span: int = 96) -> DataFrame:
    """The different paragraphs without a licence of all texts: known word pairs ``_held`` and number of windows ``_n``.

    Of the paragraphs, in windows, those count that hold two known word pairs
    or more and less than half of every template: they carry no licence."""
    words = F.transform(F.split(text_col, BLOCKS), lambda x: F.regexp_extract_all(F.lower(x), F.lit(WORDS), F.lit(0)))
    held = df.select(F.explode(words).alias("_words")).select(F.explode(F.expr(windows("_words", list(vocabulary_of(templates)), span))).alias("_held"))
    near = F.exists(literal(templates), lambda t: (2 * F.size("_held") >= F.size(t["needed"][0])) & (2 * F.size(F.array_intersect(t["needed"][0], F.col("_held"))) >= F.size(t["needed"][0])))
    return held.where(F.size("_held") > 1).groupBy("_held").agg(F.count(F.lit(1)).alias("_n")).where(~near)


def passed_by(model: LicenceModel, unknown: DataFrame, alarm: float, grid: int = 10_000) -> float:
    """The lowest score, in steps of 1 / ``grid``, above which at most a share of ``alarm`` of the windows in ``unknown`` lies; 0 for none."""
    top = F.array_max(F.transform(likelihoods(model, F.col("_held")), lambda x: x["score"]))
    # At most grid + 1 rows come.
    steps = unknown.groupBy(F.ceil(top * grid).alias("_step")).agg(F.sum("_n").alias("_n")).collect()
    above, most = 0, alarm * sum(r["_n"] for r in steps)
    for r in sorted(steps, key=lambda r: -r["_step"]):
        above += r["_n"]
        if above > most:
            return r["_step"] / grid
    return 0.0


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = NOTICES, confirm: float = 0.8, span: int = 96,
        train_rows: int = 1_000, alarm: float = 0.001) -> LicenceModel:
    """Train against all paragraphs of one half of the corpus and calibrate the unknown class on all of the other.

    The different :func:`paragraphs` fall into halves by a hash.  All of one
    half are the regressions' negative examples: up to ``train_rows`` are
    trained on at once, more by :func:`train_spread`, where they weigh as much as
    ``train_rows`` together, so that the notices keep their share.  Of the
    windows of the other half at most a share of ``alarm`` may pass the
    threshold, which starts from that of :func:`train` and rises no further
    than the score that changed notices reach (``reach``), or 0.5.  An empty table, or one without such paragraphs, leaves the
    threshold of :func:`train`.
    """
    from strongroom.llm.common import discard, stored_at

    table, path = stored_at(paragraphs(df, text_col, templates, span).withColumn("_at", F.xxhash64("_held")), "licence_unknown")
    trained = table.where(F.pmod("_at", F.lit(2)) == 0)
    n = trained.count()
    if n <= train_rows:
        model = train(templates, [r["_held"] for r in trained.orderBy("_at").collect()], confirm=confirm)
    else:
        model = train_spread(trained, n, train_rows / n, templates, confirm=confirm)
    high = passed_by(model, table.where(F.pmod("_at", F.lit(2)) == 1), alarm)
    discard(df.sparkSession, path)
    return replace(model, threshold=min(max(model.threshold, high), max(0.5, model.reach)))


def scan_paragraphs(df: DataFrame, model: LicenceModel, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = NOTICES, confirm: float = 0.8, span: int = 96) -> DataFrame:
    """Per row: the id, ``n_paragraphs`` (with a licence), ``families`` (by name, joined by commas) and ``score`` (the highest probability, 0 if none).

    Paragraphs are the blocks between empty lines of the whole text; wrapped
    lines of a block are one text, read in windows of twice ``span`` words that
    start every ``span`` words, so any ``span`` words in a row lie in one
    window.  All known word pairs of a window go into the regressions; the
    families with at least the model's threshold are named, with none the
    window is unknown.  A named family counts if the window holds most word
    pairs of one of its templates and most of those that tell it from each
    similar template of another family.  Windows that no template can confirm
    are left out before.  SPDX tags count for each known identifier in their
    line, with score 1.

    Null and empty texts have no paragraph and score 0; repeated rows give
    repeated results; there are no ties, as families don't compete; an empty
    table gives none; other columns of ``df`` don't matter.
    """
    known = sorted(model.weights)
    letters: dict[str, dict[str, list[str]]] = {}
    for p in anchors(templates, confirm):
        one, two = (w.replace(".", r"\.") for w in p.split(" "))
        letters.setdefault(one[0], {}).setdefault(one[1:], []).append(two)
    starts = "|".join(c + "(?:" + "|".join(f"{rest}[^a-z0-9]+(?:{'|'.join(twos)})" for rest, twos in sorted(some.items())) + ")" for c, some in sorted(letters.items()))
    tag = r"(?i)spdx-license-identifier:([^\n]*)"
    hint = rf"(?i)(?<![a-z0-9])(?:{starts}|spdx-license-identifier:)"
    shapes = literal(templates)

    def found(held: Column) -> Column:
        named = F.filter(likelihoods(model, held), lambda x: x["score"] >= model.threshold)
        sure = lambda x: F.exists(shapes, lambda t: (t["family"] == x["family"]) & F.forall(t["needed"], lambda d: F.size(F.array_intersect(d, held)) >= confirm * F.size(d)))
        return F.filter(named, sure)

    ids = sorted(SPDX, key=len, reverse=True)

    def tagged(block: Column) -> Column:
        names = F.flatten(F.transform(F.regexp_extract_all(block, F.lit(tag), F.lit(1)), lambda x: F.regexp_extract_all(F.lower(x), F.lit("[a-z0-9][a-z0-9.+-]*"), F.lit(0))))
        family = lambda x: F.coalesce(*[F.when(x.startswith(i) if i.endswith("-") else x.rlike(rf"^{i}(?![a-z0-9])"), F.lit(SPDX[i])) for i in ids])
        each = F.transform(names, lambda x: F.struct(family(x).alias("family"), F.lit(1.0).alias("score")))
        return F.filter(each, lambda x: x["family"].isNotNull())

    none = F.array().cast("array<string>")
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    blocks = F.filter(F.split("_text", BLOCKS), lambda x: x.rlike(hint))
    rows = rows.select("_id", F.when(F.col("_text").rlike(hint), blocks).otherwise(none).alias("_blocks"))
    rows = rows.select("_id", F.transform("_blocks", lambda x: F.struct(tagged(x).alias("tags"), F.regexp_extract_all(F.lower(x), F.lit(WORDS), F.lit(0)).alias("words"))).alias("_blocks"))
    rows = rows.select("_id", F.expr(f"transform(_blocks, b -> struct(b.tags as tags, {windows('b.words', known, span)} as held))").alias("_blocks"))
    rows = rows.select("_id", F.transform("_blocks", lambda b: F.concat(b["tags"], F.flatten(F.transform(b["held"], found)))).alias("_blocks"))
    rows = rows.select("_id", F.filter("_blocks", lambda b: F.size(b) > 0).alias("_blocks")).withColumn("_found", F.flatten("_blocks"))
    return rows.select(F.col("_id").alias(id_col), F.size("_blocks").cast("long").alias("n_paragraphs"),
                       F.array_join(F.array_sort(F.array_distinct(F.transform("_found", lambda d: d["family"]))), ",").alias("families"),
                       F.coalesce(F.array_max(F.transform("_found", lambda d: d["score"])), F.lit(0.0)).alias("score"))
