"""Personal data, and terms that give it away, by information-theoretic sanitisation.

The base finds emails, ip addresses, card and phone numbers by pattern. Each different value is a protected
entity c. What else reveals it is estimated from the corpus: of all words, those within ``WINDOW``
words of an entity's occurrences are its context. With n(t) the occurrences of a term in the corpus,
n(c) the context words of the entity and n(c, t) those that are the term, out of N words in all, the information that the
term gives of the entity is PMI(c; t) = log2(n(c, t) N / (n(t) n(c))), and the entity's own is IC(c) = -log2(n(c) / N). A
term discloses the entity when it leaves at most ``RESIDUAL_BITS`` of IC(c), which is -log2(n(c, t) / n(t)), and has
been seen in at least ``SUPPORT`` different contexts (copies of one text are one context).
Such terms are marked wherever they stand. A term is generalised to its class (a number, a name, a word) if the class leaves more
than ``CLASS_BITS`` of the entity, else it is removed.

Texts are read three times: for base spans and contexts, for the counts of terms that have the support, and for
the places of terms that disclose. The two choices between are tables in Spark; what a task is told of them is a
bitmap of hashes of fixed size, and exact joins follow. Counts are summed in the tasks before they are shuffled, so neither
a frequent entity nor a frequent word gathers in one task.

Edge cases: null, empty and blank texts have no spans. Null or repeated ids do not matter, equal texts have equal
spans. Base spans of different kinds may overlap; terms inside a base span are left to it. An empty table gives
no rows. Columns are read by the names given; others do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celluloid.llm.common import ship, staged

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WINDOW = 8
SUPPORT = 4
RESIDUAL_BITS = 0.5
CLASS_BITS = 1.0
FILTER_BITS = 26  # of a bitmap of terms: 8 MB
HELD_TERMS = 1 << 17  # counted in a task before they are passed on

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is tried from its start only: what fails there fails within
ADDRESS = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"\w+")
DIGITS = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of a local part, ``@`` and a dotted domain. The domain is found first and the local part is
    what stands before it, so that long runs of letters are read once."""
    free = 0
    for found in DOMAIN.finditer(text):
        at = found.start()
        free = max(free, text.rfind("@", free, at) + 1)
        start = free + len(text[free:at].rstrip(LOCAL))
        if start < at:
            yield start, found.end()
            free = found.end()


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    found = [("email", *span) for span in emails(text)] if "@" in text else []
    for m in ADDRESS.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "") if m.end() - m.start() >= 13 else ""
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.findall(m[0])) <= 15]
    return found


def entity(kind: str, value: str) -> str:
    """One spelling of a value."""
    if kind == "email":
        return f"{kind} {value.lower()}"
    if kind == "ip":
        return f"{kind} " + ".".join(str(int(p)) for p in value.split("."))
    return f"{kind} " + "".join(DIGITS.findall(value))


def term_class(token: str) -> str:
    return "\0number" if any(c.isdigit() for c in token) else "\0name" if token[0].isupper() else "\0word"


def _inside(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[str, int, int]]) -> np.ndarray:
    """Which tokens overlap a span."""
    edge = np.zeros(len(starts) + 1, dtype=np.int64)
    for _, start, end in spans:
        edge[np.searchsorted(ends, start, "right")] += 1
        edge[np.searchsorted(starts, end, "left")] -= 1
    return np.cumsum(edge[:-1]) > 0


def contexts(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, list[str]]]:
    """Per span, its entity and the tokens around it that are no part of a span."""
    tokens = list(TOKEN.finditer(text))
    starts, ends = np.array([t.start() for t in tokens]), np.array([t.end() for t in tokens])
    free = np.flatnonzero(~_inside(starts, ends, spans)) if len(tokens) else np.zeros(0, dtype=int)
    for kind, start, end in spans:
        left = np.searchsorted(starts[free], start) if len(free) else 0
        around = free[max(0, left - WINDOW) : left + WINDOW]
        yield entity(kind, text[start:end]), [tokens[k][0] for k in around]


def text_key(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text.encode())


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


BASE = "doc_id long, key binary, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base string, entity string, term string, context long, n long"
_BASE = pa.schema(
    [("doc_id", pa.int64()), ("key", pa.binary()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base", pa.string())]
    + [("entity", pa.string()), ("term", pa.string()), ("context", pa.int64()), ("n", pa.int64())]
)


def base_rows(docs: DataFrame) -> DataFrame:
    """A row per document (doc_id, key, n_email .. n_phone, base), and the context terms of its entities (entity, term, context, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in _BASE]
            pairs: Counter[tuple[str, str, int]] = Counter()
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                spans = base_spans(text)
                kinds = Counter(k for k, _, _ in spans)
                for column, value in zip(columns, [doc_id, text_key(text), *(kinds[k] for k in KINDS), joined(spans), None, None, None, None]):
                    column.append(value)
                for name, tokens in contexts(text, spans) if spans else ():
                    context = xxhash.xxh3_64_intdigest(" ".join(tokens).lower().encode()) >> 1
                    for token in tokens:
                        pairs[name, token.lower(), context] += 1
                        pairs[name, term_class(token), context] += 1
            for (name, term, context), n in pairs.items():
                for column, value in zip(columns, [None] * (len(_BASE) - 4) + [name, term, context, n]):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _BASE)], schema=_BASE)

    return docs.mapInArrow(run, BASE)


def term_hash(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.encode()) & ((1 << FILTER_BITS) - 1)


def bitmap(terms: DataFrame) -> Broadcast:
    """Bits of the terms' hashes: an inexact filter of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = pa.array([term_hash(t) for t in batch.column("term").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([places], names=["place"])

    place = F.col("place")
    rows = terms.select("term").mapInArrow(run, "place long")
    parts = rows.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    made = np.zeros((((1 << FILTER_BITS) >> 15) + 1, 4096), dtype=np.uint8)
    for row in parts.collect():  # 4 kB each, 2 ** (FILTER_BITS - 15) + 1 at most
        made[row["part"]] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return terms.sparkSession.sparkContext.broadcast(made.reshape(-1))


class Known:
    """Tokens that a bitmap may hold; what it said of a token is remembered for a while."""

    def __init__(self, held: Broadcast):
        self.bits = held.value
        self.seen: dict[str, bool] = {}

    def __call__(self, token: str) -> bool:
        said = self.seen.get(token)
        if said is None:
            place = term_hash(token.lower())
            # buckets of the bitmap are numbered from 1, bucket 0 is for values up to 0
            part, bit = ((place - 1) // 32_768 + 1, (place - 1) % 32_768) if place else (0, 0)
            said = bool(self.bits[part * 4_096 + (bit >> 3)] >> (bit & 7) & 1)
            if len(self.seen) >= HELD_TERMS:
                self.seen.clear()
            self.seen[token] = said
        return said


def term_counts(docs: DataFrame, held: Broadcast) -> DataFrame:
    """(term, n) of the terms in the bitmap and of the term classes, over all texts; the term is null for all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words = Known(held), Counter()
        totals: Counter[str | None] = Counter()

        def passed() -> pa.RecordBatch:
            for token, n in words.items():
                totals[None] += n
                totals[term_class(token)] += n
                if known(token):
                    totals[token.lower()] += n
            made = pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], names=["term", "n"])
            words.clear()
            totals.clear()
            return made

        for batch in batches:
            for text in batch.column("text"):
                words.update(TOKEN.findall(text.as_py() or ""))
                if len(words) >= HELD_TERMS:
                    yield passed()
        yield passed()

    return docs.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def disclosures(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """(term, entity, pmi, ic, removed): what each disclosing term gives away, by the entity that it tells most of.

    ``pairs`` holds (entity, term, context, n) of all context terms."""
    apart = pairs.groupBy("entity", "term", "context").agg(F.sum("n").alias("n"))
    both = apart.groupBy("entity", "term").agg(F.sum("n").alias("both"), F.count("*").alias("contexts"))
    both = staged(both, "disclosure-pairs")
    size = both.where(F.col("term").startswith("\0")).groupBy("entity").agg(F.sum("both").alias("context_words"))
    likely = both.where(~F.col("term").startswith("\0") & (F.col("contexts") >= SUPPORT))
    counts = staged(term_counts(docs, bitmap(likely.select("term").distinct())), "disclosure-terms")
    total = counts.where("term is null").first()  # one row
    words = float(total["n"]) if total else 1.0
    bits = lambda share: -F.log2(share)
    known = likely.join(counts.where("term is not null"), "term").join(size, "entity")
    own = bits(F.col("context_words") / words)
    residual = bits(F.col("both") / F.col("n"))
    known = known.select("entity", "term", own.alias("ic"), (own - residual).alias("pmi"))
    told = known.where(F.col("ic") - F.col("pmi") <= RESIDUAL_BITS)
    best = told.groupBy("term").agg(F.min_by(F.struct("entity", "pmi", "ic"), F.struct(F.col("ic") - F.col("pmi"), F.col("entity"))).alias("best"))
    best = best.select("term", "best.*")
    # three classes for each entity
    of_class = both.where(F.col("term").startswith("\0")).join(F.broadcast(counts.where(F.col("term").startswith("\0"))), "term")
    of_class = of_class.select(F.col("entity"), F.col("term").alias("class"), bits(F.col("both") / F.col("n")).alias("left"))
    telling = of_class.where(F.col("left") <= CLASS_BITS).groupBy("entity").agg(F.collect_set("class").alias("telling"))
    return best.join(telling, "entity", "left").select("term", "entity", "pmi", "ic", F.coalesce("telling", F.array()).alias("telling"))


PLACES = "key binary, term string, class string, start int, end int"


def places(docs: DataFrame, held: Broadcast) -> DataFrame:
    """(key, term, class, start, end) of the tokens that the bitmap may hold, outside base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(held)
        for batch in batches:
            made: list[tuple] = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                if not any(map(known, set(TOKEN.findall(text)))):
                    continue
                key = text_key(text)
                hits = [t for t in TOKEN.finditer(text) if known(t[0])]
                covered = _inside(np.array([t.start() for t in hits]), np.array([t.end() for t in hits]), base_spans(text))
                made += [(key, t[0].lower(), term_class(t[0]), *t.span()) for t, c in zip(hits, covered) if not c]
            if made:
                kinds = (pa.binary(), pa.string(), pa.string(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["key", "term", "class", "start", "end"])

    return docs.select("text").mapInArrow(run, PLACES)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the text), n_email .. n_phone, base (spans as text) and terms: array of (start, end, action,
    class) in the order of their places; action is ``generalise`` or ``remove``."""
    ship(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = staged(base_rows(texts), "disclosure-base")
    base = rows.where("entity is null").select("doc_id", "key", *(f"n_{k}" for k in KINDS), "base")
    told = staged(disclosures(rows.where("entity is not null").select("entity", "term", "context", "n"), texts), "disclosure-told")
    found = places(texts, bitmap(told.select("term"))).distinct()  # equal texts have equal places
    action = F.when(F.array_contains("telling", F.col("class")), "remove").otherwise("generalise")
    found = found.join(told.select("term", "telling"), "term").select("key", F.struct("start", "end", action.alias("action"), F.substring("class", 2, 10).alias("class")).alias("place"))
    terms = found.groupBy("key").agg(F.array_sort(F.collect_list("place")).alias("terms"))  # no more than a text has words
    return base.join(terms.withColumnRenamed("key", "of_key"), F.col("key") == F.col("of_key"), "left").drop("of_key")


def all_spans(found: DataFrame) -> Column:
    """Base spans and terms as ``kind:start:end``, joined by commas."""
    terms = F.transform(F.col("terms"), lambda t: F.concat(F.lit(f"{TERM}:"), t["start"], F.lit(":"), t["end"]))
    return F.array_join(F.concat(F.when(F.col("base") != "", F.array("base")).otherwise(F.array()), F.coalesce(terms, F.array())), ",")


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id, text with personal data replaced by its kind, disclosing terms by their class or by nothing."""
    found = find(docs).select("key", "base", "terms").dropDuplicates(["key"]).where((F.col("base") != "") | F.col("terms").isNotNull())

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [text_key(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["doc_id", "text", "of_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [rewritten(t, b, p) for t, b, p in zip(*(batch.column(c).to_pylist() for c in ("text", "base", "terms")))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(keyed, "doc_id long, text string, of_key binary")
    both = texts.join(found, F.col("of_key") == F.col("key"), "left").select("doc_id", "text", "base", "terms")
    return both.mapInArrow(run, "doc_id long, text string")


def rewritten(text: str | None, base: str | None, terms: list[dict] | None) -> str | None:
    """Overlapping spans are replaced as one, by the kind of the first."""
    if text is None:
        return None
    spans = [(int(a), int(b), f"[{k.upper()}]") for k, a, b in (s.split(":") for s in base.split(","))] if base else []
    spans += [(t["start"], t["end"], f"[{t['class'].upper()}]" if t["action"] == "generalise" else "") for t in terms or ()]
    made, done = [], 0
    for start, end, mark in sorted(spans):
        if start >= done:
            made += [text[done:start], mark]
        done = max(done, end)
    return "".join(made) + text[done:]
