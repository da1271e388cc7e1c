"""Licence scans: base places by brute force, rules, suppression."""

import random
import re

from roadlake.llm import licenses

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    return [w.decode() for w in WORD.findall(raw)]


def base(text):
    w = words(text)
    at = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(w)) if tuple(w[i : i + len(phrase)]) == phrase]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def key(r):
    return tuple((x is not None, x) for x in r)


def test_base_against_brute_force(documents):
    rng = random.Random(1)
    vocabulary = ["cc", "CC", "by", "general", "Public", "license", "all", "rights", "reserved", "é", "x1", "GNU"]
    docs = [(i, rng.choice([" ", "-", "\n", ". "]).join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(150)]
    docs += [(200, None), (201, ""), (None, "cc by cc by"), (5, "cc by"), (5, "cc by"), (202, "Cc" + " by cc" * 900), (203, "İcc by ÉALL rights reserved")]
    out = licenses.scan(documents(docs, w="x", rid=3, found=1)).collect()
    assert sorted((key((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in out)) == sorted(
        key((d, *base(t))) for d, t in docs
    )
    for r in out:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted(set(filter(None, r.labels.split(",")))))


def test_rules_labels_and_suppression(documents):
    texts = {
        1: ("Licensed under the Apache License, Version 2.0.", "apache"),
        2: ("Released under the MIT License.", "mit"),
        3: ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
        4: ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        5: ("SPDX-License-Identifier: MPL-2.0", "mpl"),
        6: ("All rights reserved. Copyright (c) 2020 X", "copyright,reserved"),
        7: ("Nothing of the kind, not even permission.", ""),
        8: ("see the LICENSE", "unknown-license"),
        9: ("permission is hereby granted, free of charge,\nto any person obtaining a copy", "mit"),
    }
    out = {r.doc_id: r for r in licenses.scan(documents([(i, t) for i, (t, _) in texts.items()])).collect()}
    assert {i: r.labels for i, r in out.items()} == {i: want for i, (_, want) in texts.items()}
    assert out[7].score == 0 and out[7].places == [] and out[1].score > 0.8
    for r in out.values():
        norm = " " + " ".join(words(texts[r.doc_id][0])) + " "
        for p in r.places:
            assert norm[p.start - 1] == " " == norm[p.end]
            assert not any(q != p and q.start <= p.start and q.end > p.end and q.label == p.label for q in r.places)


def test_containment_by_priority(spark):
    rows = [(1, 0, 10, 1, "a", 2, 0.5), (1, 2, 8, 2, "b", 2, 0.5), (1, 0, 10, 0, "c", 2, 0.5), (1, 1, 9, 3, "d", 5, 0.5),
            (1, 20, 25, 4, "e", 1, 0.5), (1, 20, 30, 5, "f", 1, 0.5), (2, 2, 8, 2, "g", 1, 0.5), (1, 24, 34, 6, "h", 1, 0.5)]
    df = spark.createDataFrame(rows, "rid long, start long, end long, rule int, label string, priority int, weight double")
    assert sorted(r.label for r in licenses.kept_places(df).collect()) == ["c", "d", "f", "g", "h"]


def test_rules_are_hundreds_and_gated():
    made = licenses.rules()
    assert len(made) >= 250 and all(re.compile(r[3]) and re.fullmatch(r"[a-z0-9]+", r[2]) for r in made)


def test_empty_table_and_native_plan(documents, capsys):
    df = licenses.scan(documents([]))
    assert df.count() == 0
    df.explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


def spellings(pattern):
    """All texts that a rule's pattern matches, digit ranges by their first digit."""
    from re import _parser

    def of(items):
        out = [""]
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                own = [chr(arg)]
            elif name == "IN":
                own = [chr(a if str(o) == "LITERAL" else a[0]) for o, a in arg]
            elif name == "BRANCH":
                own = [x for b in arg[1] for x in of(b)]
            elif name == "SUBPATTERN":
                own = of(arg[3])
            elif name == "MAX_REPEAT":
                assert arg[:2] == (0, 1)
                own = ["", *of(arg[2])]
            else:
                assert name in ("ASSERT", "ASSERT_NOT"), name
                own = [""]
            out = [x + y for x in out for y in own]
        return out

    return of(_parser.parse(pattern))


def test_every_spelling_of_a_rule_holds_its_keyword():
    for _, label, keyword, pattern, _, _ in licenses.rules():
        for text in spellings(pattern):
            assert re.search(pattern, f" {text} ") and keyword in text.split(), (label, keyword, text)


def test_every_name_is_found_alone(documents):
    want = {}
    for label, _, name, _ in licenses.FAMILIES:
        for n in spellings(name):
            want[len(want)] = (f"Released under the {n} License", label)
    names = {
        "mit": ("Expat", "X11"), "bsd": ("Berkeley Software Distribution",), "isc": ("Internet Systems Consortium",),
        "cddl": ("Common Development and Distribution",), "eupl": ("European Union Public",), "ofl": ("SIL Open Font",),
        "odbl": ("Open Database",),
    }
    for label, some in names.items():
        for n in some:
            want[len(want)] = (f"licensed under the {n} License", label)
    want[len(want)] = ("has waived all copyright and related rights", "cc0")
    out = licenses.scan(documents([(i, t) for i, (t, _) in want.items()])).collect()
    for r in out:
        assert want[r.doc_id][1] in r.labels.split(","), want[r.doc_id]
