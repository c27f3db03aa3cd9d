from __future__ import annotations

import re
import time

from lakeshore.llm import license_scan as ls
from lakeshore.llm.common import table
from tests.conftest import SF_CHECK


def words(text):
    return re.sub("[^a-z0-9]+", " ", (text or "").lower()).split()


def grams(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def brute(rows, templates):
    """(doc_id, license_id): best share of the template's shingles in a window of the document."""
    out = {}
    for name, text in templates:
        t = set(grams(words(text)))
        named = {g for g in t if re.search(ls.VERSION, " ".join(g))}
        c = 1
        while c < len(t):
            c *= 2
        for doc_id, doc in rows:
            h = grams(words(doc))
            for s in range(0, len(h), c):
                window = set(h[s : s + 2 * c])
                share = len(t & window) / len(t) if t else 0
                if share >= 0.8 and (not named or named & window) and share > out.get((doc_id, name), (0, 0))[0]:
                    out[doc_id, name] = (share, s)
    return out


def test_whole_documents_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF_CHECK, "documents").collect()]
    got = {(r.doc_id, r.license_id): (r.containment, r.first_shingle) for r in ls.op5_license_scan(spark, SF_CHECK).collect()}
    assert got and got == brute(rows, ls.TEMPLATES)


def test_edited_templates_and_odd_rows(spark):
    long = ls.TEMPLATES[6][1]
    w = long.split()
    rows = [(1, None), (2, ""), (3, "one two"), (4, "x " * 50 + long + " y" * 70), (5, " ".join([*w[:19], "zzz", *w[20:]])),
            (6, long + " " + long), (None, "Released under the MIT license!"), (8, "released under the mit " * 3), (9, "r\n" * 100000)]
    templates = [*ls.TEMPLATES, ("short", "too short")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, width int")
    t = spark.createDataFrame(templates, "license_id string, text string")
    got = {(r.doc_id, r.license_id): (r.containment, r.first_shingle) for r in ls.scan_licenses(docs, t).collect()}
    assert got == brute(rows, templates) and (None, "MIT") in got
    assert ls.scan_licenses(docs.limit(0), t).count() == 0
    assert ls.scan_licenses(docs, t.limit(0)).count() == 0


def test_versions_are_told_apart(spark):
    gpl = "This work is licensed under the GNU General Public License, version {}."
    rows = [(k, gpl.format(k) + " filler" * 30) for k in (1, 2, 3)] + [(9, gpl.format(2) + " and " + gpl.format(3))]
    rows += [(4, "This work is licensed under a Creative Commons Attribution 3.0 International License.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    t = spark.createDataFrame(ls.TEMPLATES, "license_id string, text string")
    got = {(r.doc_id, r.license_id) for r in ls.scan_licenses(docs, t).collect()}
    assert got == {(2, "GPL-2.0"), (3, "GPL-3.0"), (9, "GPL-2.0"), (9, "GPL-3.0")} == set(brute(rows, ls.TEMPLATES))


def test_whole_texts_from_a_folder(spark, tmp_path):
    texts = {f"L{k}": " ".join(f"w{(k * 7919 + i * i) % 4001}" for i in range(3000)) for k in range(6)}
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    t = ls.read_templates(spark, str(tmp_path))
    rows = [(k, "before " * 40 + text.replace("w17", "edited") + " after" * 40) for k, text in enumerate(texts.values())]
    docs = spark.createDataFrame([*rows, (99, "w1 w2 w3 " * 500)], "doc_id long, text string")
    begun = time.time()
    found = ls.scan_licenses(docs, t)
    assert time.time() - begun < 15  # the plan does not grow with the templates
    assert {(r.doc_id, r.license_id) for r in found.collect()} == {(k, f"L{k}") for k in range(6)}
