"""Alignment of the tokens of two tokenizers over the same bytes.

Both id lists of a text are turned into cumulative byte ends. A dictionary per
side leads from an end to its index; the ends that are keys of both, sorted, cut
both lists into groups, and every A token of a group is linked with every B token
of it.

A byte-level BPE and a piece model both begin a token at a single blank before a
word, so the ends there are common to both. Texts are cut there, and each distinct
word (blank included) is encoded and aligned once per worker process; a text's
groups are those of its words in a row. A tokenizer for which this does not hold,
and a text whose words do not give back their bytes, are encoded whole.

Counts over the corpus: a task works in chunks of at most CHUNK_CHARS characters of
text. For each chunk it writes the distinct id pairs with their number of documents
(one column array) and per document the numbers of its pairs in that list. Spark
sums the pairs of all chunks, takes each A id's best, and brings the sums back to
the chunks, where a grouped task adds up its documents. Rows of the shuffles are pairs
of a chunk, never pairs of a document.

Null and empty texts, and texts whose tokens do not give the bytes of blank + text,
have no tokens: zeros, and '' for the groups. Repeated rows are documents of their
own. Texts of any length are read whole. An empty table gives no rows. Ties for an
A id's best all count as best. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stage
from quire.llm.tokens import _SIMPLE, WordEncoder, _byte_chars, default_tokenizer

#: Text that a task aligns at once, and that shares one list of pairs.
BATCH_CHARS, CHUNK_CHARS = 4_000_000, 24_000_000
#: Words (and characters of words) that a worker remembers between batches, and A stems.
CACHE_WORDS, CACHE_CHARS, CACHE_STEMS = 600_000, 8_000_000, 100_000
#: Links of one slice that are listed one by one.
SLICE_LINKS = 4096
#: Pairs in one row of a chunk's list.
ROW_PAIRS = 100_000

_CUT = re.compile(r"(?<! ) (?=\S)")
_ODD = re.compile(r" (?!\S)")

CHUNKS = pa.schema([
    ("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups", pa.string()), ("links", pa.binary()),
    ("first", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("docs", pa.list_(pa.int64()))])
CHUNKS_SQL = ("chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, links binary, "
              "first long, a array<int>, b array<int>, docs array<long>")
ROWS = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
                 + [("groups", pa.string())])
ROWS_SQL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# --- one text --------------------------------------------------------------------

def common_slices(lengths_a: list[int], lengths_b: list[int]) -> list[tuple[int, int, int, int]]:
    """(a0, a1, b0, b1) of the groups between the byte ends that both lists have."""
    at_a = dict(zip(accumulate(lengths_a), range(1, len(lengths_a) + 1)))
    at_b = dict(zip(accumulate(lengths_b), range(1, len(lengths_b) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    a1, b1 = list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))
    return list(zip([0, *a1], a1, [0, *b1], b1))


class Aligner:
    """Both tokenizers and what has been aligned so far. Per word (with its blank): the
    sizes, the groups as text, and the id pairs of its links."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = WordEncoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        back = {c: b for b, c in _byte_chars().items()}
        size = self.a.tok.get_vocab_size()
        entries = [self.a.tok.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(back.get(c, 0) for c in t) for t in entries]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        self.name_a = [f"{i}|" for i in range(len(self.bytes_a))]
        self.name_b = [str(i) for i in range(len(self.bytes_b))]
        self.by_word = self.a.by_word and not any(re.search("[^▁]▁", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.groups: list[str] = []
        self.chars = 0
        self.sizes = array("q")  # n_a (-1: bytes differ), n_b, n_groups, n_links of each word
        self.pair_end, self.pair_id, self.pair_n = array("q"), array("q"), array("q")

    def _ids_a(self, word: str) -> list[int]:
        """A's ids of a blank and `word`."""
        if self.by_word and (m := _SIMPLE.fullmatch(word)):
            if len(self.a.stems) > CACHE_STEMS:
                self.a.stems.clear()
            got = self.a._stem(" " + m[1]) + (self.a._stem(m[2]) if m[2] else b"")
        else:
            got = self.a._whole(" " + word)
        return array(self.a.code, got).tolist()

    def learn(self, words: list[str]) -> None:
        """Encode and align words that are not known yet, all of them in a row: behind
        one another they are one stretch of bytes, in which every word's end is common."""
        known = len(self.groups)
        self.index.update(zip(words, range(known, known + len(words))))
        self.chars += sum(map(len, words))
        ids = [list(map(self._ids_a, words)), self.b.encode(words, num_threads=1)]
        good = self._gives_back(words, ids)
        kept = [[x for x, ok in zip(side, good) if ok] for side in ids]
        word = np.flatnonzero(good)
        count = [np.fromiter(map(len, side), np.int64, len(side)) for side in kept]
        a, b = (list(chain.from_iterable(side)) for side in kept)
        flat_a, flat_b = np.array(a, np.int64), np.array(b, np.int64)
        slices = np.array(common_slices(self.size_a[flat_a].tolist(), self.size_b[flat_b].tolist()), np.int64).reshape(-1, 4)
        a0, a1, b0, b1 = slices.T
        owner = np.repeat(word, count[0])[a1 - 1]  # the word of each group
        links = (a1 - a0) * (b1 - b0)
        texts = list(map(add, map(self.name_a.__getitem__, flat_a[a0].tolist()), map(self.name_b.__getitem__, flat_b[b0].tolist())))
        for g in np.flatnonzero(links > 1).tolist():
            texts[g] = ",".join(map(str, a[a0[g]:a1[g]])) + "|" + ",".join(map(str, b[b0[g]:b1[g]]))
        # the links of every slice, each A token with each B token
        few = np.flatnonzero(links <= SLICE_LINKS)
        g = np.repeat(few, links[few])
        k = np.arange(len(g)) - np.repeat(np.cumsum(links[few]) - links[few], links[few])
        width = (b1 - b0)[g]
        pairs = [(owner[g], flat_a[a0[g] + k // width] << 32 | flat_b[b0[g] + k % width], np.ones(len(g), np.int64))]
        for g in np.flatnonzero(links > SLICE_LINKS).tolist():  # equal ids of a long slice are counted first
            each_b = Counter(b[b0[g]:b1[g]]).items()
            each = [(x << 32 | y, i * j) for x, i in Counter(a[a0[g]:a1[g]]).items() for y, j in each_b]
            pairs.append(([owner[g]] * len(each), *zip(*each)))
        of, pair, n = (np.concatenate([np.asarray(x, np.int64) for x in column]) for column in zip(*pairs))
        order = np.argsort(of, kind="stable")
        self.pair_id.frombytes(pair[order].tobytes())
        self.pair_n.frombytes(n[order].tobytes())
        before = self.pair_end[-1] if self.pair_end else 0
        self.pair_end.frombytes((before + np.cumsum(np.bincount(of, minlength=len(words)))).tobytes())
        sizes = np.zeros((len(words), 4), np.int64)
        sizes[~good, 0] = -1
        sizes[word, 0], sizes[word, 1] = count
        n_groups = np.bincount(owner, minlength=len(words))
        sizes[:, 2], sizes[:, 3] = n_groups, np.bincount(owner, links, len(words))
        self.sizes.frombytes(sizes.tobytes())
        end = np.cumsum(n_groups).tolist()
        self.groups += [";".join(texts[x:y]) for x, y in zip([0, *end], end)]

    def _gives_back(self, words: list[str], ids: list[list[list[int]]]) -> np.ndarray:
        """Whether the tokens of both sides give the bytes of each word."""
        good = np.ones(len(words), bool)
        whole = [(" " + w).encode() for w in words]
        for side, piece in zip(ids, (self.bytes_a, self.bytes_b)):
            joined = [b"".join(map(piece.__getitem__, x)) for x in side]
            if joined != whole:
                good &= np.fromiter((x == y for x, y in zip(joined, whole)), bool, len(words))
        return good

    def words(self, text: str) -> list[str]:
        """The words of blank + text, each without its blank."""
        if not self.by_word:
            return [text]
        if text[0] != " " and not _ODD.search(text):
            return text.split(" ")
        first, *rest = _CUT.split(" " + text)
        return [first[1:], *rest] if first else rest

    def batch(self, texts: list[str]) -> dict:
        """Sizes and groups of each text, and the distinct pairs of each: `owner`
        (place of the text), `pair` and `n` (links), sorted by owner and pair."""
        if len(self.groups) > CACHE_WORDS or self.chars > CACHE_CHARS:
            self.forget()
        split = [self.words(t) for t in texts]
        self.learn(list({w for words in split for w in words if w not in self.index}))
        found = [list(map(self.index.__getitem__, words)) for words in split]
        sizes = np.array(self.sizes, np.int64).reshape(-1, 4)
        end, pair_id, pair_n = (np.array(x, np.int64) for x in (self.pair_end, self.pair_id, self.pair_n))
        flat = np.fromiter((i for ids in found for i in ids), np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(ids) for ids in found])
        bad = np.zeros(len(texts), bool)
        bad[owner[sizes[flat, 0] < 0]] = True
        # a text with a word that does not give back its bytes: looked at as one word
        whole = {k: self._whole(texts[k]) for k in np.flatnonzero(bad)}
        ok = ~bad[owner]
        flat, owner = flat[ok], owner[ok]
        total = np.stack([np.bincount(owner, sizes[flat, c], len(texts)) for c in range(4)], 1).astype(np.int64)
        groups = [";".join(map(self.groups.__getitem__, ids)) if not bad[k] else "" for k, ids in enumerate(found)]
        key = np.unique(owner * len(sizes) + flat, return_counts=True)
        owner, word, times = key[0] // max(1, len(sizes)), key[0] % max(1, len(sizes)), key[1]
        start = end[word - 1] * (word > 0)
        n = end[word] - start
        row = np.repeat(np.arange(len(word)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[row]
        parts = [(owner[row], pair_id[at], pair_n[at] * times[row])]
        for k, got in whole.items():
            if got is not None:
                total[k], groups[k], ids, ns = got
                parts.append((np.full(len(ids), k), np.array(ids, np.int64), np.array(ns, np.int64)))
        owner, pair, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((pair, owner))
        owner, pair, n = owner[order], pair[order], n[order]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])
        at = np.flatnonzero(new)
        return {"total": total, "groups": groups, "owner": owner[at], "pair": pair[at],
                "n": np.add.reduceat(n, at) if len(at) else n}

    def _whole(self, text: str):
        """(sizes, groups, pairs, links) of a whole text as one word; None if its bytes differ."""
        alone = Aligner.__new__(Aligner)
        alone.__dict__.update(self.__dict__)
        alone.forget()
        alone.by_word = False
        alone.learn([text])
        if alone.sizes[0] < 0:
            return None
        return alone.sizes[:4], alone.groups[0], list(alone.pair_id), list(alone.pair_n)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker process."""
    return Aligner(path_a, path_b)


# --- chunks ------------------------------------------------------------------------

def _packed(index: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending numbers and their counts as a compressed block: the bytes of the
    steps and counts by place, so that the mostly empty high ones take no room."""
    step = np.diff(index, prepend=0).astype("<u4")
    planes = np.concatenate([step.view(np.uint8).reshape(-1, 4).T.ravel(), n.astype("<u4").view(np.uint8).reshape(-1, 4).T.ravel()])
    return len(index).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpacked(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(block[:4], "little")
    raw = np.frombuffer(pa.decompress(block[4:], size * 8, "zstd", asbytes=True), np.uint8)
    step, n = (np.ascontiguousarray(x.reshape(4, -1).T).view("<u4").ravel() for x in (raw[:size * 4], raw[size * 4:]))
    return np.cumsum(step, dtype=np.int64), n.astype(np.int64)


def _chunk_rows(chunk: int, parts: list[dict]) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk, then its list of pairs."""
    listed = np.unique(np.concatenate([p["pair"] for p in parts]))
    docs = np.zeros(len(listed), np.int64)
    for p in parts:
        index = np.searchsorted(listed, p["pair"])
        docs += np.bincount(index, minlength=len(listed))
        edge = np.searchsorted(p["owner"], np.arange(len(p["doc_id"]) + 1))
        links = [_packed(index[x:y], p["n"][x:y]) for x, y in zip(edge[:-1], edge[1:])]
        rows = len(links)
        yield pa.record_batch([pa.array([chunk] * rows, pa.int64()), pa.array(p["doc_id"], pa.int64()),
                               *(pa.array(p["total"][:, c]) for c in range(4)), pa.array(p["groups"], pa.string()),
                               pa.array(links, pa.binary()), *(pa.nulls(rows, f.type) for f in list(CHUNKS)[8:])], schema=CHUNKS)
    for x in range(0, len(listed), ROW_PAIRS):
        some = listed[x:x + ROW_PAIRS]
        columns = [[x], [(some >> 32).astype(np.int32)], [(some & 0xFFFFFFFF).astype(np.int32)], [docs[x:x + ROW_PAIRS]]]
        yield pa.record_batch([pa.array([chunk]), *(pa.nulls(1, f.type) for f in list(CHUNKS)[1:8]),
                               *(pa.array(c, f.type) for c, f in zip(columns, list(CHUNKS)[8:]))], schema=CHUNKS)


def _in_chunks(path_a: str, path_b: str, digest: bool, batch_chars: int, chunk_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(path_a, path_b)
        chunk = TaskContext.get().partitionId() << 24
        ids, texts, parts = [], [], []
        waiting = held = 0

        def take() -> None:
            got = tool.batch([t or " " for t in texts])
            got["doc_id"] = list(ids)
            empty = np.array([not t for t in texts], bool)
            got["total"][empty] = 0
            some = ~empty[got["owner"]]
            for c in ("owner", "pair", "n"):
                got[c] = got[c][some]
            got["groups"] = ["" if e or not g else hashlib.sha256(g.encode()).hexdigest() if digest else g
                             for e, g in zip(empty, got["groups"])]
            parts.append(got)
            ids.clear()
            texts.clear()

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py()
                ids.append(doc)
                texts.append(text)
                waiting += len(text or "") + 8
                if waiting >= batch_chars:
                    held += waiting
                    waiting = 0
                    take()
                    if held >= chunk_chars:
                        yield from _chunk_rows(chunk, parts)
                        chunk, held = chunk + 1, 0
                        parts.clear()
        if ids:
            take()
        if parts:
            yield from _chunk_rows(chunk, parts)

    return run


def aligned_chunks(documents: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = False,
                   batch_chars: int = BATCH_CHARS, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Staged rows of two kinds: documents (sizes, groups as `a1,a2|b1;a3|b2,b3` or, with
    `digest`, their sha256, and the pairs as numbers in the chunk's list) and lists of pairs.
    A chunk is named by its task's partition, of which the stage keeps one attempt."""
    run = _in_chunks(path_a or default_tokenizer(), path_b or default_pieces(), digest, batch_chars, chunk_chars)
    return stage(documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, CHUNKS_SQL), "chunks")


def _listed(chunks: DataFrame) -> DataFrame:
    """(chunk, place, a, b, docs): the pairs of every chunk."""
    return chunks.where("first IS NOT NULL").select("chunk", "first", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("i", "x")) \
        .select("chunk", (F.col("first") + F.col("i")).cast("int").alias("place"), "x.a", "x.b", "x.docs")


def _corpus_pairs(chunks: DataFrame) -> DataFrame:
    counts = _listed(chunks).groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))
    return counts.join(top, "a").select("a", "b", "docs", (F.col("docs") == F.col("top")).alias("best"))


def linked_ids(documents: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(a, b, docs, best): every id pair that some document links, the number of documents
    that do, and whether that is the most of its A id."""
    return _corpus_pairs(aligned_chunks(documents, path_a, path_b, digest=True))


def _add_up(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Best links and summed counts of the documents of one chunk."""
    if not docs.num_rows:
        return ROWS.empty_table()
    place = pairs["place"].to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place] = pairs["docs"].to_numpy()
    best[place] = pairs["best"].to_numpy(zero_copy_only=False)
    sums = []
    for block in docs["links"]:
        index, n = _unpacked(block.as_py())
        sums.append((int((n * best[index]).sum()), int((n * count[index]).sum())))
    got = np.array(sums, np.int64)
    return pa.table([docs["doc_id"], *(docs[c] for c in ("n_a", "n_b", "n_groups", "n_links")), pa.array(got[:, 0]),
                     pa.array(got[:, 1]), docs["groups"]], schema=ROWS)


def align(documents: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = False,
          **chunking) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links (A-B token pairs that share
    a group), n_best (links whose id pair is held by as many documents as any of its A id),
    count_sum (documents of the links' id pairs, added up) and the groups (see `aligned_chunks`)."""
    chunks = aligned_chunks(documents, path_a, path_b, digest, **chunking)
    known = stage(_corpus_pairs(chunks), "pairs")
    back = _listed(chunks).select("chunk", "place", "a", "b").join(known, ["a", "b"]) \
        .select(F.col("chunk").alias("of"), "place", "docs", "best")
    docs = chunks.where("first IS NULL").select("chunk", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "links")
    return docs.groupBy("chunk").cogroup(back.groupBy("of")).applyInArrow(_add_up, ROWS_SQL)
