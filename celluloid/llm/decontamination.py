"""Benchmark decontamination: BM25 retrieval of test items with block-max pruning.

An item is a question and an answer. Its words (lower case, marks stripped from their ends) are cut
into chunks of at most ``CHUNK_WORDS``; the chunks are the documents of an inverted BM25 index. The
passages of a training text, windows of two neighbouring cells of ``CHUNK_WORDS`` words, are the queries,
each distinct word once. A chunk is retrieved when its score reaches ``RETRIEVE`` of the score that all
of its words would give, or those of the question or answer where that one alone can make a match.

Chunks are sorted by their most frequent term and that threshold, and laid in blocks; a term has a largest impact in each of its
blocks. Terms that are in many blocks add their largest impact everywhere, one number a passage; for
the rest the block maxima of a passage's words are summed. Only where both together reach the least
threshold of a block are chunks scored, with the rare terms first, and a block is left when the
common ones cannot lift any chunk of it to its threshold. So the retrieval is the one without
pruning.

A retrieved item is verified on the words of the text: its ``width``-word shingles that occur there must
cover ``overlap`` of all its words, question and answer in a row, or of the words of each of both (one of
fewer words counts when it occurs as a whole). An answer of fewer than twice ``width`` words, all of whose shingles one
changed word can take away, does not decide beside a question that is longer.

The index of at most ``SHARD_WORDS`` words of items is broadcast. Larger benchmarks are cut into such
shards, each of which is held against all texts, so the broadcast does not grow with the benchmark.

Edge cases: null or empty texts match nothing. Items without words, null item ids and null items are
left out. A null answer leaves the question to decide, and the other way round. Repeated rows of
documents are judged each; repeated items each give their matches. Other columns of documents pass
through ``clean``; ``matches`` returns ids only.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celluloid.llm.common import ship, words

CHUNK_WORDS = 48
RETRIEVE = 0.5
OVERLAP = 0.6
WIDTH = 5
BLOCK_CHUNKS = 2
SPAN_CELLS = 2_000_000
COMMON_BLOCKS = 64  # terms in more blocks count as common
K1, B = 1.2, 0.75
SHARD_WORDS = 1_000_000
EPSILON = 1e-9
MARKS = b" .,;:!?\"'()[]{}*_-#$%&|<>"


def plain(word: bytes) -> bytes:
    return word.decode().lower().encode().strip(MARKS)


def plain_words(text: str | None) -> list[bytes]:
    return [w for w in map(plain, words(text)) if w]


@dataclass
class Item:
    item_id: int
    question: list[bytes]
    answer: list[bytes]

    def alone(self, width: int, overlap: float) -> list[list[bytes]]:
        """The question or answer when its words make a match without the other's."""
        n = len(self.question) + len(self.answer)
        parts = [p for p in (self.question, self.answer) if len(p) >= overlap * n]
        return [self.question] if not parts and self.question_decides(width) else parts

    def question_decides(self, width: int) -> bool:
        return len(self.question) >= 2 * width > len(self.answer)


class Index:
    """Inverted index of item chunks."""

    def __init__(self, items: list[Item], width: int = WIDTH, overlap: float = OVERLAP):
        self.items = items
        chunks = []
        for number, item in enumerate(items):
            whole = item.question + item.answer
            parts = -(-len(whole) // CHUNK_WORDS)
            cuts = np.linspace(0, len(whole), parts + 1).astype(int)
            chunks += [(number, whole[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.terms: dict[bytes, int] = {}
        seen: dict[int, int] = defaultdict(int)
        for _, part in chunks:
            for word in set(part):
                seen[self.terms.setdefault(word, len(self.terms))] += 1
        mean = np.mean([len(c[1]) for c in chunks]) if chunks else 1.0
        idf = np.array([np.log1p((len(chunks) - seen[t] + 0.5) / (seen[t] + 0.5)) for t in range(len(self.terms))])
        impacts = []
        for number, part in chunks:
            own: dict[int, float] = {}
            for word in set(part):
                term, often = self.terms[word], part.count(word)
                own[term] = float(idf[term] * often * (K1 + 1) / (often + K1 * (1 - B + B * len(part) / mean)))
            # of several chunks one lies inside such a part
            alone = items[number].alone(width, overlap) if len(part) == len(items[number].question) + len(items[number].answer) else []
            least = min([sum(own.values()), *(sum(own[self.terms[w]] for w in set(p)) for p in alone)])
            impacts.append((RETRIEVE * least, number, own))
        # neighbours share their most frequent term, so that texts of one language meet in a block
        impacts.sort(key=lambda x: (max((seen[t], t) for t in x[2])[1], *x[:2]))
        self.chunk_item = [n for _, n, _ in impacts]
        self.chunk_threshold = np.array([t for t, _, _ in impacts])
        self.chunk_terms = [own for _, _, own in impacts]
        self.blocks = -(-len(impacts) // BLOCK_CHUNKS)
        self.block_threshold = np.array([self.chunk_threshold[k : k + BLOCK_CHUNKS].min() for k in range(0, len(impacts), BLOCK_CHUNKS)])
        best: dict[int, dict[int, float]] = defaultdict(dict)
        for place, own in enumerate(self.chunk_terms):
            block = place // BLOCK_CHUNKS
            for term, impact in own.items():
                best[term][block] = max(best[term].get(block, 0.0), impact)
        self.common = np.zeros(len(self.terms))
        self.first = np.zeros(len(self.terms) + 1, dtype=np.int64)
        block_of, maximum = [], []
        for term in range(len(self.terms)):
            if len(best[term]) > COMMON_BLOCKS:
                self.common[term] = max(best[term].values())
            else:
                block_of += sorted(best[term])
                maximum += [best[term][b] for b in sorted(best[term])]
            self.first[term + 1] = len(block_of)
        self.block_of, self.maximum = np.array(block_of, dtype=np.int64), np.array(maximum)
        lists = sorted((term, place, impact) for place, own in enumerate(self.chunk_terms) for term, impact in own.items())
        self.list_first = np.searchsorted([x[0] for x in lists], np.arange(len(self.terms) + 1))
        self.list_chunk = np.array([x[1] for x in lists], dtype=np.int64)
        self.list_impact = np.array([x[2] for x in lists])
        self.known = _Terms(self)

    def retrieve(self, found: list[bytes]) -> set[int]:
        """Items one of whose chunks some passage retrieves."""
        terms = np.fromiter(map(self.known.__getitem__, found), dtype=np.int64, count=len(found))
        hits: set[int] = set()
        span = max(2, SPAN_CELLS // max(1, self.blocks)) * CHUNK_WORDS  # bounds the memory of a long text
        for start in range(0, len(terms), span):
            hits |= self._retrieve(terms[start : start + span + CHUNK_WORDS])
        return hits

    def _retrieve(self, terms: np.ndarray) -> set[int]:
        places = np.flatnonzero(terms < len(self.terms))
        if not len(places) or not self.blocks:
            return set()
        cell = places // CHUNK_WORDS
        passages = max(1, -(-len(terms) // CHUNK_WORDS) - 1)  # a passage is a cell and the next
        wide = len(self.terms)
        key = np.concatenate([np.minimum(cell, passages - 1) * wide + terms[places], np.maximum(cell - 1, 0) * wide + terms[places]])
        passage, term = np.divmod(np.unique(key), wide)  # each distinct term once
        everywhere = np.bincount(passage, weights=self.common[term], minlength=passages)
        owner, entry = _spread(self.first, term)
        where = passage[owner] * self.blocks + self.block_of[entry]
        bound = np.bincount(where, weights=self.maximum[entry], minlength=passages * self.blocks).reshape(passages, self.blocks)
        open_blocks = bound + everywhere[:, None] >= self.block_threshold - EPSILON
        return self._scored(passage, term, everywhere, open_blocks)

    def _scored(self, passage: np.ndarray, term: np.ndarray, rest: np.ndarray, open_blocks: np.ndarray) -> set[int]:
        """Items whose chunks reach their threshold for a passage in its open blocks; rare terms first, so
        that a passage is left when the common ones (at most rest) cannot lift a chunk any more."""
        chunks = len(self.chunk_threshold)
        score = np.zeros((0, chunks))
        rows, inside = np.arange(len(open_blocks)), open_blocks
        for rare in (True, False):
            some = inside.any(axis=1)
            rows, inside = rows[some], inside[some]
            if not len(rows):
                return set()
            score = score[some] if len(score) else np.zeros((len(rows), chunks))
            place = np.full(len(open_blocks), -1)
            place[rows] = np.arange(len(rows))
            own = (place[passage] >= 0) & ((self.common[term] == 0) == rare)
            owner, entry = _spread(self.list_first, term[own])
            where = place[passage[own]][owner] * chunks + self.list_chunk[entry]
            score = score + np.bincount(where, weights=self.list_impact[entry], minlength=score.size).reshape(score.shape)
            if rare:
                inside = np.repeat(inside, BLOCK_CHUNKS, axis=1)[:, :chunks]
                inside = inside & (score + rest[rows, None] >= self.chunk_threshold - EPSILON)
        reached = (inside & (score >= self.chunk_threshold - EPSILON)).any(axis=0)
        return {self.chunk_item[k] for k in np.flatnonzero(reached)}


def _spread(first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of each term's list: which of ``terms`` owns it, and its place."""
    counts = first[terms + 1] - first[terms]
    owner = np.repeat(np.arange(len(terms)), counts)
    ends = np.cumsum(counts)
    return owner, np.arange(len(owner)) - np.repeat(ends - counts, counts) + np.repeat(first[terms], counts)


class _Terms(dict):
    """Term number of a raw word, remembered for a bounded number of words."""

    LIMIT = 400_000

    def __init__(self, index: Index):
        super().__init__()
        self.index = index

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        number = self[word] = self.index.terms.get(plain(word), len(self.index.terms))
        return number


def covered(part: list[bytes], text: set[tuple[bytes, ...]], width: int) -> float:
    """Share of the part's words inside shingles that the text has; text: its shingles of this width."""
    inside = np.zeros(len(part), dtype=bool)
    for at in range(len(part) - width + 1):
        if tuple(part[at : at + width]) in text:
            inside[at : at + width] = True
    return float(inside.mean())


def verify(item: Item, found: list[bytes], shingles: dict[int, set], width: int, overlap: float) -> tuple[bool, float, float]:
    """Whether the item overlaps, and by how much question and answer do. shingles: those known of the text, by width."""
    shares = []
    for part in (item.question, item.answer, item.question + item.answer):
        if not part:
            shares.append(1.0)
            continue
        own = min(width, len(part))
        if own not in shingles:
            shingles[own] = set(zip(*(found[k:] for k in range(own))))
        shares.append(covered(part, shingles[own], own))
    question, answer, whole = shares
    decides = question if item.question_decides(width) else min(question, answer)
    return max(decides, whole) >= overlap, question, answer


def question_and_answer(text: str) -> tuple[Column, Column]:
    """A passage's last sentence is the answer, what stands before it the question; one sentence is a question."""
    at = r"(?s)^(.*[.!?])\s+(\S.*)$"
    whole = F.trim(F.col(text))
    split = whole.rlike(at)
    return F.when(split, F.regexp_extract(whole, at, 1)).otherwise(whole), F.when(split, F.regexp_extract(whole, at, 2))


def shards(items: DataFrame, shard_words: int = SHARD_WORDS) -> list[list[Item]]:
    """Items in groups of at most ``shard_words`` words, read shard by shard."""
    count = F.coalesce(F.length("question"), F.lit(0)) + F.coalesce(F.length("answer"), F.lit(0))
    known = items.where("item_id is not null").select("item_id", "question", "answer", (count / 4).cast("long").alias("_words"))
    total = known.agg(F.sum("_words").alias("s")).first()["s"] or 0
    parts = int(total // shard_words) + 1
    made = []
    for part in range(parts):
        rows = known.where(F.pmod(F.xxhash64("item_id", "question"), F.lit(parts)) == part).toLocalIterator()
        held = [Item(r["item_id"], plain_words(r["question"]), plain_words(r["answer"])) for r in rows]
        made.append(sorted((i for i in held if i.question or i.answer), key=lambda i: (i.item_id, i.question, i.answer)))
    return made


def _held_against(docs: DataFrame, items: list[Item], width: int, overlap: float) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(items)  # SHARD_WORDS words of items
    schema = T.ArrayType(T.StructType().add("item_id", "long").add("question_overlap", "double").add("answer_overlap", "double"))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(held.value, width, overlap)
        for texts in batches:
            rows = []
            for text in texts:
                raw = words(text.as_py())
                hits = index.retrieve(raw)
                matched = []
                if hits:
                    found = [w for w in map(plain, raw) if w]
                    shingles: dict[int, set] = {}
                    for number in sorted(hits):
                        good, question, answer = verify(index.items[number], found, shingles, width, overlap)
                        if good:
                            matched.append({"item_id": index.items[number].item_id, "question_overlap": question, "answer_overlap": answer})
                rows.append(matched)
            yield pa.array(rows, pa.list_(pa.struct([("item_id", pa.int64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64())])))

    return docs.withColumn("_matches", F.arrow_udf(run, schema).asNondeterministic()("text"))


def matches(docs: DataFrame, items: DataFrame, width: int = WIDTH, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, question_overlap, answer_overlap) of every text and item that match."""
    ship(docs.sparkSession)
    texts, found = docs.select("doc_id", "text"), None
    for shard in shards(items):
        part = _held_against(texts, shard, width, overlap).select("doc_id", F.explode("_matches").alias("m")).select("doc_id", "m.*")
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, overlap: float = OVERLAP) -> DataFrame:
    """The document rows that match no item, with their columns."""
    ship(docs.sparkSession)
    for shard in shards(items):
        docs = _held_against(docs, shard, width, overlap).where(F.size("_matches") == 0).drop("_matches")
    return docs
