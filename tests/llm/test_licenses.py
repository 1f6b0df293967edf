import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linecast.llm import licenses as L
from linecast.llm.common import table
from tests.llm.helpers import SCHEMA, awkward, clashing, empty, prose

SF = "/root/testdata/sf0.01"
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Proprietary": "All rights reserved.",
}


@pytest.fixture(scope="module")
def model(spark):
    return L.fit(table(spark, SF, "documents"))


def test_notices_in_documents(spark, model):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    got = {r["doc_id"]: r["families"] for r in L.summarize(docs, L.find_licenses(docs, model)).collect()}
    for r in docs.collect():
        lines = r["text"].split("\n")
        assert got[r["doc_id"]] == ",".join(sorted(f for f, t in NOTICES.items() if t in lines)), r["doc_id"]


def test_families_variants_and_lookalikes(spark, model):
    texts = [t for _, t in L.TEMPLATES] + [
        "  * LICENSED UNDER THE APACHE LICENSE, VERSION 2.0 *", "The license of this version was general and public.", "He was released under the rain.", "Licensed", prose(8, 40).replace("\n", " "),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in L.summarize(docs, L.find_licenses(docs, model)).collect()}
    for i, (family, _) in enumerate(L.TEMPLATES):
        assert got[i] == family, texts[i]
    n = len(L.TEMPLATES)
    assert [got[n + i] for i in range(5)] == ["Apache-2.0", "", "", "", ""]


def test_awkward_rows(spark):
    docs = clashing(awkward(spark)).unionByName(clashing(spark.createDataFrame([(50, "a\n" + NOTICES["MIT"] + "\r\n" + NOTICES["MIT"], "en", "a", 1, 1)], SCHEMA)))
    rows = L.summarize(docs, L.find_licenses(docs, L.fit(docs))).collect()
    assert len(rows) == docs.count()
    assert {(r["doc_id"], r["n_notices"], r["families"]) for r in rows if r["families"]} == {(50, 2, "MIT")}


def test_empty_table(spark):
    docs = empty(spark)
    model = L.fit(docs)
    assert model.lr is None and L.summarize(docs, L.find_licenses(docs, model)).collect() == []


GPL = "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version {} of the License, or\n(at your option) any later version."
AGPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
CASES = [
    (GPL.format(2), 1, "GPL-2.0"),
    (GPL.format(3), 1, "GPL-3.0"),
    ("/*\n" + "\n".join(" * " + x for x in GPL.format(2).split("\n")) + "\n */\nint main() {}", 1, "GPL-2.0"),
    (GPL.format(2).split("\n")[0], 0, ""),
    (AGPL, 0, ""),
    ("Licensed under CC BY 3.0.", 0, ""),
    ("This work is licensed under a Creative Commons Attribution 3.0 Unported License.", 0, ""),
    ("Licensed under the Apache Software License, Version 1.1.", 0, ""),
    (GPL.format(3).replace("program", "library").replace("GNU General", "GNU Lesser General"), 0, ""),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice.", 1, "BSD"),
    ("Licensed under the MIT License and the Apache License, Version 2.0.", 2, "Apache-2.0,MIT"),
    ("Licensed under the\nApache License, Version 2.0 (the \"License\"); you may not use this file except\nin compliance with the License.\nReleased under the MIT License.", 2, "Apache-2.0,MIT"),
    ("a heading without a full stop\nReleased under the MIT License.\nand what follows it", 1, "MIT"),
]


def test_wrapped_two_and_foreign_notices(spark, model):
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(CASES)], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_notices"], r["families"]) for r in L.summarize(docs, L.find_licenses(docs, model)).collect()}
    for i, (text, n, families) in enumerate(CASES):
        assert got[i] == (n, families), text


def test_cutoff_comes_from_lookalikes(model):
    assert 0.5 < model.cutoff < 1


def _plain_words(text):
    return re.findall(r"[a-z0-9]+(?:[.+-]+[a-z0-9]+)*", text.lower())


def _plain_units(text):
    """(passage, part, words), read line by line."""
    passages, go_on = [], False
    for line in (text or "").split("\n"):
        latin = re.match(r"[ \t]*[*#/;>-]*[ \t]*[A-Za-z0-9(\"']", line)
        if go_on and latin:
            passages[-1].append(line)
        else:
            passages.append([line])
        end = line.rstrip(" \t\r")
        go_on = bool(end) and end[-1] not in ".!?:|" and not end[-1].isspace()
    for p, lines in enumerate(passages):
        parts = [" ".join(lines), *lines] if len(lines) > 1 else lines
        for n, part in enumerate(parts):
            if _plain_words(part):
                yield p, n, _plain_words(part)


def test_equals_plain_version(spark, model):
    """Classifier and confirmation in plain Python and numpy, on whole texts."""
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text").collect()]
    rows += [(-1 - i, t) for i, (t, _, _) in enumerate(CASES)]
    place = {w: i for i, w in enumerate(model.counter.vocabulary)}
    weights, bias = model.lr.coefficientMatrix.toArray(), model.lr.interceptVector.toArray()
    expected = {}
    for i, text in rows:
        per = {}
        for p, part, words in _plain_units(text):
            x = np.zeros(len(place))
            for t in words + [" ".join(w) for w in zip(words, words[1:])]:
                if t in place:
                    x[place[t]] += 1
            z = weights @ x + bias
            e = np.exp(z - z.max())
            e /= e.sum()
            if z.argmax() == len(e) - 1 or 1 - e[-1] < model.cutoff:
                continue
            grams = {" ".join(words[j:j + 3]) for j in range(max(1, len(words) - 2))}
            for f, q in zip(model.families[:-1], e):
                share = max(len(grams & set(own)) / min(len(grams), len(own)) for g, own in model.templates if g == f)
                if q >= L.MIN_FAMILY and share >= L.MIN_OVERLAP and re.search(L.TELLING[f], " ".join(words)):
                    per.setdefault(p, []).append((part, f))
        found = [x for all_ in per.values() for x in ([y for y in all_ if y[0] == 0] or all_)]
        expected[i] = (len(found), ",".join(sorted({f for _, f in found})))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_notices"], r["families"]) for r in L.summarize(docs, L.find_licenses(docs, model)).collect()}
    assert got == expected and sum(n for n, _ in got.values()) > 12


def _plain_notice(model, words):
    """(probability of being a notice, confirmed families) of a passage, None for the first if it is likeliest unknown."""
    place = {w: i for i, w in enumerate(model.counter.vocabulary)}
    x = np.zeros(len(place))
    for t in words + [" ".join(w) for w in zip(words, words[1:])]:
        if t in place:
            x[place[t]] += 1
    z = model.lr.coefficientMatrix.toArray() @ x + model.lr.interceptVector.toArray()
    e = np.exp(z - z.max())
    e /= e.sum()
    grams = {" ".join(words[j:j + 3]) for j in range(max(1, len(words) - 2))}
    share = {f: max(len(grams & set(own)) / min(len(grams), len(own)) for g, own in model.templates if g == f) for f in model.families[:-1]}
    found = [f for f, q in zip(model.families, e) if f in share and q >= L.MIN_FAMILY and share[f] >= L.MIN_OVERLAP and re.search(L.TELLING[f], " ".join(words))]
    return (None if z.argmax() == len(e) - 1 else 1 - e[-1]), found


def test_model_and_cutoff_come_from_every_passage(spark, model):
    """More passages than the former sample of 4,000 lines: each distinct one counts."""
    docs = table(spark, SF, "documents")
    rows = L.paragraphs(docs, "doc_id", "text").select("words", F.xxhash64("words").alias("h")).dropDuplicates(["h"]).collect()
    grams = {g for _, own in model.templates for g in own}
    odd = [r["words"] for r in rows if r["h"] % 2]
    even = [r["words"] for r in rows if not r["h"] % 2]
    assert len(rows) > 4000 and model.spared == len(odd)
    assert model.trained == sum(not any(" ".join(w[j:j + 3]) in grams for j in range(max(1, len(w) - 2))) for w in even)
    alike = L._windows(L._templates(spark, [(L.UNKNOWN, t) for t in L.LOOKALIKES])).collect()
    each = min(1.0, L.CORPUS_WEIGHT / len(odd))
    tried = [(w, each) for w in odd] + [(r["words"], 1.0) for r in alike]
    none = sorted(((p, w) for (p, found), w in ((_plain_notice(model, words), w) for words, w in tried) if p is not None and not found), reverse=True)
    allowed = (1 - L.QUANTILE) * sum(w for _, w in tried)
    over = [p for i, (p, _) in enumerate(none) if sum(w for _, w in none[:i + 1]) > allowed]
    assert model.cutoff == pytest.approx(max(0.5, over[0]), rel=1e-9)


def test_every_document_takes_part(spark):
    """2,500 documents with three passages of their own each, and a shared one."""
    def own(i, j):
        return f"w{i} " + prose(3 * i + j, 6).replace("\n", " ") + f" x{j}."
    texts = ["\n".join([own(i, j) for j in range(3)] + ["The same line everywhere."]) for i in range(2500)]
    model = L.fit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert model.trained + model.spared == 3 * 2500 + 1


def test_highest_is_exact(spark):
    r = np.random.default_rng(1)
    values = [(float(x), bool(a)) for x, a in zip(np.round(r.random(3000) ** 0.01, 6), r.random(3000) < 0.3)]
    values += [(np.nextafter(0.75, 1.0).item(), False), (0.75, False), (0.75, True)]
    counts = spark.createDataFrame(values, "notice double, alike boolean")
    ordered = sorted((x for x, _ in values), reverse=True)
    for n in (0, 1, 17, 2900, len(values) - 1):
        assert L._highest(counts, lambda passages, windows: passages + windows > n) == ordered[n]
    assert L._highest(counts, lambda passages, windows: passages + windows > len(values)) is None
    only = sorted((x for x, a in values if a), reverse=True)
    assert L._highest(counts, lambda passages, windows: windows > 40) == only[40]


def test_normal_words_equal_plain_ones(spark):
    texts = ["a\x00b é—, x\x0by\x7f K İstanbul ß.\r\n b ü\U0001f600c + -1.5- x\x85y z\nv2.0 -a- b.c.d", "\n\n \n", prose(5, 60), *(t for _, t in L.TEMPLATES)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["id"], r["passage"], r["part"]): r["words"] for r in L.paragraphs(docs, "doc_id", "text").collect()}
    assert got == {(i, p, n): w for i, t in enumerate(texts) for p, n, w in _plain_units(t.replace("\x0b", " "))}
