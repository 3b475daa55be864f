"""Personal data and disclosing terms against the plain patterns and counts."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from helpers import DOCS, sentences
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from celluloid.llm import disclosure as dc
from celluloid.llm import queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def passes(number):
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(number[::-1])]
    return sum(doubled) % 10 == 0


def plain_spans(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and passes(digits(m[0]))]
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="aZ09._%+-@ ()é\n", max_size=60) | st.lists(st.sampled_from(["a@b.c", "1.2.3.255", "4111 1111 1111 1111", "+1 (555) 010-9999", "@", ".", "0", " ", "256.1.1.1", "x", "4111111111111111"]), max_size=12).map("".join))
def test_base_spans(text):
    assert dc.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 100_000, "@a" * 100_000, "+1 " * 100_000, "a@" * 100_000, "9 " * 200_000):
        dc.base_spans(text)


def told(texts):
    """{term: removed classes} by counting."""
    words, pairs, seen, size = Counter(), Counter(), defaultdict(set), Counter()
    for text in texts:
        tokens = list(re.finditer(r"\w+", text))
        for t in tokens:
            words[t[0].lower()] += 1
            words[dc.term_class(t[0])] += 1
        spans = plain_spans(text)
        free = [t for t in tokens if not any(a < t.end() and t.start() < b for _, a, b in spans)]
        for kind, a, b in spans:
            near = [t for t in free if t.start() < a][-dc.WINDOW :] + [t for t in free if t.start() >= a][: dc.WINDOW]
            name = dc.entity(kind, text[a:b])
            for t in near:
                for term in (t[0].lower(), dc.term_class(t[0])):
                    pairs[name, term] += 1
                    seen[name, term].add(" ".join(x[0] for x in near).lower())
            size[name] += len(near)
    left = {key: -math.log2(n / words[key[1]]) for key, n in pairs.items()}
    found = {}
    for (name, term), bits in sorted(left.items(), key=lambda x: (x[1], x[0])):
        if term[0] != "\0" and bits <= dc.RESIDUAL_BITS and len(seen[name, term]) >= dc.SUPPORT and term not in found:
            found[term] = {c for c in ("\0number", "\0name", "\0word") if left.get((name, c), 9) <= dc.CLASS_BITS}
    return found


def corpus():
    rows = [(k, sentences(k, 40), "en", "s") for k in range(40)]
    who = "ilse.brandt@mail.example.com"
    rows += [(100 + k, f"{sentences(k, 20)} Harbourmaster Oslund wrote {who} on day {k} {sentences(k + 500, 20)}", "en", "s") for k in range(6)]
    rows += [(200 + k, f"{sentences(7, 9)} rarecopy {sentences(8, 3)} +49 (30) 5550 1234 {sentences(9, 12)}", "en", "s") for k in range(30)]  # copies: one context
    rows += [(300, "The Harbourmaster is gone. OSLUND too, é.", "en", "s"), (301, "", "en", "s"), (302, None, "en", "s"), (None, "x 10.0.0.1", None, None), (301, "a@b.co 10.0.0.1 4111 1111 1111 1111 +1 555 010 9999", "en", "s")]
    # a number that only stands beside one address
    rows += [(400 + k, f"{sentences(k + 50, 12)} 192.0.2.7 badge 77{sentences(1, 1)} 48213 {sentences(k + 90, 12)}", "en", "s") for k in range(5)]
    rows += [(500, "long " * 200_000 + "Oslund", "en", "s")]
    return rows


def test_against_counts(spark, tmp_path):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 0) for r in rows], DOCS).repartition(7)
    docs.withColumns({c: F.lit("clash") for c in ("key", "base", "term", "entity", "n", "terms", "place")}).write.parquet(str(tmp_path / "documents.parquet"))
    removed = told([r[1] or "" for r in rows])
    assert {"harbourmaster", "oslund", "48213"} <= set(removed) and "rarecopy" not in removed
    expected = []
    for doc_id, text, *_ in rows:
        text = text or ""
        base = plain_spans(text)
        terms = [("term", *t.span()) for t in re.finditer(r"\w+", text) if t[0].lower() in removed and not any(a < t.end() and t.start() < b for _, a, b in base)]
        counts = Counter(k for k, _, _ in base)
        spell = lambda spans: ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected.append((doc_id, *(counts[k] for k in dc.KINDS), hashlib.sha256(spell(base).encode()).hexdigest(), spell(base + terms)))
    got = [tuple(r) for r in queries.op12_disclosure(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)
    clean = dict(dc.sanitise(docs.where("doc_id in (300, 302, 400) or doc_id between 100 and 105 or doc_id < 40")).where("doc_id in (300, 302, 105)").collect())
    assert clean[302] is None and "[EMAIL]" in clean[105] and "ilse.brandt" not in clean[105]
    assert "Harbourmaster" not in clean[105] and "Harbourmaster" not in clean[300]


def test_generalised_or_removed():
    text = "Ask Ilse at a@b.co or 48213 now"
    terms = [{"start": 4, "end": 8, "action": "generalise", "class": "name"}, {"start": 22, "end": 27, "action": "remove", "class": "number"}]
    assert dc.rewritten(text, "email:12:18", terms) == "Ask [NAME] at [EMAIL] or  now"
    assert dc.rewritten("+4111111111111111", "card:1:17,phone:0:17", None) == "[PHONE]"


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(1, "  ", "en", "s", 2)]])
def test_no_words(spark, tmp_path, rows):
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op12_disclosure(spark, str(tmp_path)).collect()
    assert [(r["n_email"], r["spans"], r["base_sha256"]) for r in got] == [(0, "", hashlib.sha256(b"").hexdigest()) for _ in rows]
