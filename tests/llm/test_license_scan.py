import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm.license_scan import CONTAINMENT, MISS, NOTICES, SHINGLE, bands_for, known_templates, scan_licenses, template_class, template_words


def plain(rows, templates):
    out = []
    for i, text in rows:
        w = template_words(text or "")
        s = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        best = {}
        for name, t in templates:
            tw = template_words(t)
            ts = {tuple(tw[k : k + 5]) for k in range(len(tw) - 4)}
            c = template_class(len(tw))
            for start in range(0, len(s), c):
                share = len(ts & set(s[start : start + 2 * c - 4])) / len(ts)
                if share >= CONTAINMENT:
                    best[name] = max(share, best.get(name, 0))
        out.append((i, len(best), ",".join(sorted(best)), max(best.values(), default=0.0)))
    return sorted(out, key=str)


TEMPLATES = [*NOTICES, *(t for t in known_templates() if t[0] in ("MIT-text", "BSD-3-Clause-text", "Unlicense-text"))]


def test_against_brute_force(docs_of):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        w = [rng.choice(["the", "license", "under", "of", "é", "work", "x1"]) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            t = rng.choice(TEMPLATES)[1].split()
            if rng.random() < 0.4 and len(t) > 10:
                t[rng.randrange(len(t))] = "other"
            if rng.random() < 0.3:
                t = [x.upper() for x in t]
            at = rng.randint(0, len(w))
            w[at:at] = t[rng.choice([0, 0, 3]) :]
        rows.append((i, rng.choice([" ", "\n"]).join(w)))
    rows += [(900, None), (901, ""), (None, TEMPLATES[0][1]), (902, "filler " * 20_000 + dict(TEMPLATES)['MIT-text']), (5, rows[5][1]), (903, TEMPLATES[0][1] * 3)]
    extra = docs_of(rows).withColumns({"s": F.lit(1), "part": F.lit(2), "license": F.lit("")})
    assert sorted(map(tuple, scan_licenses(extra, TEMPLATES).collect()), key=str) == plain(rows, TEMPLATES)


def test_damaged_texts_are_retrieved(docs_of):
    """Of windows with 0.8 of a template or more none is missed: full texts, notices, and copies with words changed."""
    rng = random.Random(1)
    rows = []
    for name, text in known_templates():
        w = text.split()
        for damage in (0, 0.01, 0.03):
            copy = [x if rng.random() >= damage else "changed" for x in w]
            rows.append((len(rows), "some words before " + " ".join(copy) + " and some words after"))
    got = {r.doc_id: r for r in scan_licenses(docs_of(rows)).collect()}
    want = {r[0]: r for r in plain(rows, known_templates())}
    missed = [(i, name) for i, row in want.items() for name in row[2].split(",") if name and name not in got[i].licenses.split(",")]
    assert not missed and sum(row[1] for row in want.values()) > 2 * len(known_templates())
    assert [tuple(got[i]) for i in sorted(got)] == [want[i] for i in sorted(want)]


def test_band_settings():
    for n_words in (5, 7, 8, 9, 40, 300):
        step, n = template_class(n_words), n_words - SHINGLE + 1
        bands = bands_for(n, step)
        shared = -(-n * 4 // 5)
        jaccard = shared / (2 * step - SHINGLE + 1 + n - shared)
        assert step >= n_words and (1 - jaccard) ** bands <= MISS


def test_odd_inputs(docs_of):
    assert scan_licenses(docs_of([])).count() == 0
    assert [tuple(r) for r in scan_licenses(docs_of([(1, "a b c d e f")]), []).collect()] == [(1, 0, "", 0.0)]
    with pytest.raises(ValueError):
        scan_licenses(docs_of([(1, "a")]), [("X", "too short")])
