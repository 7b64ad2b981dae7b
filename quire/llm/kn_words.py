"""Quality rules with a word n-gram language model.

The base rules are those of kn_quality. Texts that pass are judged by the
perplexity per word of an interpolated modified Kneser-Ney model over words (runs
without ASCII blanks), one per language, of trigrams with two <s> before each text:
documents outside the language's lower and upper bands are rejected.

A text is never judged by a model that has read it, or its own rare words would
make it likely: texts fall into two folds by a hash of the whole text (so equal
texts share one), and each fold is judged by the model of the other. Words that a
model has not read share the mass of its unknown word.

No n-gram is a row of its own. A task that has read texts sends one compressed block of
sorted trigrams (codes into the block's list of word hashes) to each bucket. A trigram
(a, b, c) goes to the bucket of its middle word b, where all that a Kneser-Ney model asks
about it meets: its own count, the totals of the context (a, b), the continuation counts
of (b, c) and the totals of b. What is left are the continuation counts of single words
and, per language, the counts of counts. So the texts are read twice: first the buckets
add up trigrams, with a count for each fold, and return the counts of counts and, per
word c, how many words b precede it there; Spark sums these, and each word's sum goes
back to the buckets that have named it. Then the blocks also say in which documents a
trigram stands, and a bucket returns each document's sum of bits, which Spark adds up.

Either round takes slices of the buckets one after another, and what a slice has
shuffled is deleted before the next, so the disk holds one slice's blocks at a time. All
trigrams with the same middle word share a bucket. A bucket returns a row for each of its
documents, so there are few buckets and not one more than the largest language asks for
with BUCKET_WORDS words each; a document meets as many of them as it has distinct words at
most. A task holds the compressed blocks of one bucket and opens them for some of the
middle words at a time, PART_BYTES on average. Nothing of the model is held by the driver.
Words are 64-bit hashes of language and word.

The bands are the quantiles LOW and HIGH of the log-perplexities of the language's
documents that pass the base rules.

A null or empty text has no words and fails. Unknown (null) languages share one
model. Rows that repeat a doc_id are judged each on its own; a null doc_id is
kept. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import delete_folder, shared_folder, stage, with_uid
from quire.llm.kn_quality import MIN_WORDS, SYMBOLS, _BASE, _by_language, _per_language, dup_lines

FOLDS = (0, 1)
LOW, HIGH = 0.001, 0.965
PIECE_BYTES = 8 << 20
BUCKET_WORDS = 4_000_000
PART_BYTES = 16 << 20
LONG_WORD = 64
LEAST_BUCKETS = 24
COUNT_SLICES, WORD_SLICES, SLICES = 2, 2, 3  # of the first round, its words and the second round
_BLOCK = "lang string, bucket int, size long, block binary"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BLANK, _SYMBOL = (np.isin(np.arange(256), list(x)) for x in (b" \t\n\x0b\x0c\r", SYMBOLS))
_BEGINS = ~_BLANK & (np.arange(256) & 0xC0 != 0x80)  # first bytes of code points in words
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # masks of so many bytes


def fold_of(data: bytes) -> int:
    return zlib.crc32(data) & 1


def _number(data: bytes, key: bytes) -> int:
    return int.from_bytes(blake2b(data, digest_size=8, key=key).digest(), "little")


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xA0761D6478BD642F)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: bytes) -> np.ndarray:
    """64-bit numbers of a language's words, eight bytes at a time; long words by blake2b."""
    sizes = ends - starts
    eight = np.ndarray((len(data) + 1,), "<u8", np.append(data, np.zeros(8, np.uint8)), strides=(1,))
    out = _mix(np.uint64(_number(b"", key)) ^ sizes.astype(np.uint64))
    for at in range(0, min(int(sizes.max(initial=0)), LONG_WORD), 8):
        more = np.flatnonzero(sizes > at) if at else slice(None)
        out[more] = _mix(out[more] ^ (eight[starts[more] + at] & _FIRST[np.minimum(sizes[more] - at, 8)]))
    for k in np.flatnonzero(sizes > LONG_WORD):
        out[k] = _number(data[starts[k]:ends[k]].tobytes(), key)
    return out


@contextmanager
def _shuffles_deleted(spark: SparkSession):
    """Inside, a query's shuffle files are deleted when it ends."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _order(*columns: np.ndarray) -> np.ndarray:
    """Places of the rows in ascending order; columns of numbers from 0, the first counts most."""
    bits = [int(x.max(initial=0)).bit_length() for x in columns]
    if sum(bits) > 63:
        return np.lexsort(columns[::-1])
    key = columns[0].astype(np.int64)
    for x, n in zip(columns[1:], bits[1:]):
        key = (key << n) | x
    return np.argsort(key)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows starts."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Unsigned numbers in as few bytes as the largest needs, like bytes side by side."""
    out = []
    for x in arrays:
        x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
        out += [len(x).to_bytes(7, "little"), bytes([x.itemsize]), x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()]
    return b"".join(out)


def _unpacked(data: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(data):
        n, width = int.from_bytes(data[at:at + 7], "little"), data[at + 7]
        planes = np.frombuffer(data, np.uint8, n * width, at + 8).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(n))
        at += 8 + n * width
    return out


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit numbers and the place of each value among them."""
    coded = pa.array(values.view(np.int64)).dictionary_encode()
    return coded.dictionary.to_numpy().view(values.dtype), coded.indices.to_numpy()


def _ranked(values: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers below `size` in ascending order and the place of each value among them."""
    if 16 * len(values) < size:
        return np.unique(values, return_inverse=True)
    held = np.zeros(size, bool)
    held[values] = True
    return np.flatnonzero(held), (np.cumsum(held, dtype=np.int32) - 1)[values]


def _words(texts: list[bytes], ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Bytes of all texts with blanks around each, where texts and words start, words end, and each word's text."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    edges = np.flatnonzero(np.diff(_BLANK[data])) + 1
    after = ends + np.arange(1, len(ends) + 1)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(np.searchsorted(edges[::2], after), prepend=0))
    return data, np.append(0, after[:-1]) + 1, edges[::2], edges[1::2], owner


def _repeats(hashes: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Texts that may have a three-word window twice: all that have, and few others."""
    bits = np.uint64(n_texts.bit_length())
    window = _mix((hashes[:-2] * np.uint64(3) + hashes[1:-1]) * np.uint64(3) + hashes[2:]) << bits
    window = (window | owner[2:].astype(np.uint64))[owner[2:] == owner[:-2]]
    window.sort()
    return np.unique(window[1:][window[1:] == window[:-1]] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def _repeat_words(texts: list[bytes]) -> np.ndarray:
    """`kn_quality.repeat_words` of each text: words themselves are numbered, not their hashes."""
    words = [x.split() for x in texts]
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in words])
    c = pa.array([w for x in words for w in x], pa.large_binary()).dictionary_encode().indices.to_numpy()
    inside = np.flatnonzero(owner[2:] == owner[:-2])
    windows = [owner[inside], *[c[inside + k] for k in range(3)]]
    order = _order(*windows)
    sizes = np.diff(_starts(*[x[order] for x in windows]), append=len(order))
    twice = inside[order[np.repeat(sizes > 1, sizes)]]
    held = np.zeros(len(c), bool)
    for k in range(3):
        held[twice + k] = True
    return np.bincount(owner[held], minlength=len(texts))


def _base_columns(texts: list[bytes]) -> list[np.ndarray]:
    """`kn_quality.base_counts` of texts, a column for each count."""
    ends = np.cumsum([len(x) for x in texts])
    data, begins, starts, last, owner = _words(texts, ends)
    dup, repeat = np.array([dup_lines(x) for x in texts]), np.zeros(len(texts), np.int64)
    some = _repeats(_word_hashes(data, starts, last, b"windows"), owner, len(texts))
    repeat[some] = _repeat_words([texts[k] for k in some])
    counted = [np.add.reduceat(x[data], begins, dtype=np.int64) for x in (_BEGINS, _SYMBOL)]
    return [np.bincount(owner, minlength=len(texts)), *counted, dup, repeat]


def base_table(rows: DataFrame) -> DataFrame:
    """Base counts of `rows` (uid, text)."""
    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sizes = pc.fill_null(pc.binary_length(part.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // PIECE_BYTES)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), part.num_rows]):
                if lo < hi:
                    texts = part.column(1).slice(lo, hi - lo).cast(pa.large_binary()).to_pylist()
                    counts = [pa.array(x, pa.int64()) for x in _base_columns([x or b"" for x in texts])]
                    yield pa.RecordBatch.from_arrays([part.column(0).slice(lo, hi - lo), *counts], [x.split()[0] for x in _BASE.split(", ")])

    return rows.select("uid", "text").mapInArrow(judge, _BASE)


def _trigrams(texts: list[bytes], ends: np.ndarray, key: bytes) -> tuple[np.ndarray, np.ndarray, tuple] | None:
    """Word hashes in ascending order, and of each word its text and trigram as indexes of the hashes."""
    data, _, starts, last, owner = _words(texts, ends)
    if not len(starts):
        return None
    hashes, c = _numbered(np.append(_word_hashes(data, starts, last, key), np.uint64(_number(b"", key))))
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    c = rank[c]
    c, start = c[:-1], c[-1]
    same = owner[1:] == owner[:-1]
    b, a = np.full_like(c, start), np.full_like(c, start)
    b[1:][same] = c[:-1][same]
    a[1:][same] = b[:-1][same]
    return hashes[order], owner, (a, b, c)


def _pieces(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Of batches (lang, text, ...), for each language and about PIECE_BYTES of its texts: the
    batch, the language, the rows, their folds and `_trigrams`."""
    for part in parts:
        texts = part.column(1)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for lang, index in _by_language(part.column(0).to_pylist(), sizes):
            key = blake2b(lang.encode(), digest_size=16).digest()
            cut = np.cumsum(sizes[index]) // PIECE_BYTES
            for rows in np.split(np.array(index), np.flatnonzero(np.diff(cut)) + 1):
                mine = [x or b"" for x in texts.take(pa.array(rows)).cast(pa.large_binary()).to_pylist()]
                folds, ends = np.array([fold_of(x) for x in mine], np.uint8), np.cumsum(sizes[rows])
                if ends[-1] and (found := _trigrams(mine, ends, key)):
                    del mine
                    yield part, lang, rows, folds, *found


def _blocks(rows: DataFrame, buckets: int, slices: int, of: int, by_document: bool) -> DataFrame:
    """(lang, bucket, size, block) of the trigrams of `rows` (lang, text, uid) in the buckets of one
    of the slices: with their counts in each fold or, by_document, with each document's count."""
    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, lang, index, folds, hashes, owner, grams in _pieces(parts):
            home = (hashes % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
            by_home = np.argsort(home, kind="stable")
            place = np.empty(len(home), np.int32)
            place[by_home] = np.arange(len(home), dtype=np.int32)
            here = (home % slices == of)[grams[1]]
            owner, (a, b, c) = owner[here], (x[here] for x in grams)
            if not len(owner):
                continue
            order = _order(place[b], c, a, owner) if by_document else _order(place[b], c, a)
            owner, a, b, c = owner[order], a[order], b[order], c[order]
            first = _starts(b, c, a, owner) if by_document else _starts(b, c, a)
            if by_document:
                numbers = [owner[first], np.diff(np.append(first, len(owner)))]
            else:
                numbers = [np.add.reduceat((folds[owner] == f).astype(np.int64), first) for f in FOLDS]
            a, b, c = a[first], b[first], c[first]
            cuts = [*_starts(home[b]), len(b)]
            out = {"lang": [], "bucket": [], "size": [], "block": []}
            for lo, hi in zip(cuts, cuts[1:]):
                listed, codes = _ranked(np.concatenate([a[lo:hi], b[lo:hi], c[lo:hi]]), len(hashes))
                x, y, z = np.split(codes, 3)
                arrays = [np.diff(hashes[listed], prepend=np.uint64(0)), x, np.diff(y, prepend=y.dtype.type(0)), z]
                if by_document:
                    docs, text = _ranked(numbers[0][lo:hi], len(index))
                    uids = part.column(2).to_numpy()[index[docs]].astype(np.uint64)
                    arrays += [text, numbers[1][lo:hi], np.diff(uids, prepend=np.uint64(0)), folds[docs]]
                else:
                    arrays += [n[lo:hi] for n in numbers]
                data = _packed(arrays)
                for k, v in zip(out, (lang, int(home[b[lo]]), len(data), pa.compress(data, codec="zstd", asbytes=True))):
                    out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("size", pa.int64()),
                                                             ("block", pa.binary())]))

    return rows.select("lang", "text", *["uid"][:by_document]).mapInArrow(deal, _BLOCK)


def _opened(table: pa.Table) -> tuple[np.ndarray, Iterator[tuple]]:
    """Word hashes of a bucket's blocks; by parts of the middle words, the trigrams as indexes of
    the hashes and other arrays by block. Each of several parts opens the blocks anew and keeps its own rows."""
    def opened() -> Iterator[list[np.ndarray]]:
        for x, size in zip(table.column("block"), table.column("size")):
            yield _unpacked(pa.decompress(x.as_buffer(), size.as_py(), codec="zstd", asbytes=True))

    n_parts = -(-pc.sum(table.column("size")).as_py() // PART_BYTES)
    whole = list(opened()) if n_parts == 1 else None
    lists = [np.cumsum(x[0].astype(np.uint64)) for x in whole or opened()]
    hashes, codes = _numbered(np.concatenate(lists))
    codes = np.split(codes, np.cumsum([len(x) for x in lists])[:-1])
    del lists

    def parts() -> Iterator[tuple]:
        for k in range(n_parts):
            mine = (hashes >> np.uint64(32)) % np.uint64(n_parts) == k
            grams, more = ([], [], []), []
            for code, x in zip(codes, whole or opened()):
                b = code[np.cumsum(x[2], dtype=np.int32)]
                rows = slice(None) if whole else np.flatnonzero(mine[b])
                for held, y in zip(grams, (code[x[1][rows]], b[rows], code[x[3][rows]])):
                    held.append(y)
                more.append([*[y[rows] for y in x[4:6]], *x[6:]])
            grams = tuple(map(np.concatenate, grams))
            if len(grams[1]):
                yield grams, more

    return hashes, parts()


def _counted(grams: tuple, more: list[list[np.ndarray]]) -> tuple[tuple, list[np.ndarray]]:
    """Distinct trigrams by middle, last and first word, and their counts in each fold."""
    a, b, c = grams
    order = _order(b, c, a)
    a = a[order]
    b = b[order]
    c = c[order]
    first = _starts(b, c, a)
    n = [np.add.reduceat(np.concatenate([x[f] for x in more])[order], first, dtype=np.int64) for f in FOLDS]
    return (a[first], b[first], c[first]), n


def _tally(n: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(n, 5), minlength=5)[1:5].tolist()


def _continued(table: pa.Table) -> pa.Table:
    """Of a bucket: per word c the number of words b before it in each fold; in one more row the
    numbers of trigrams and of bigrams that occur one to four times in each fold."""
    lang, bucket = (table.column(k)[0].as_py() for k in ("lang", "bucket"))
    hashes, parts = _opened(table)
    seen, k, tally = np.zeros(len(hashes), bool), np.zeros((len(FOLDS), len(hashes)), np.int64), np.zeros(16, np.int64)
    for part in parts:
        (_, b, c), n = _counted(*part)
        first = _starts(b, c)
        m = [np.add.reduceat((x > 0).astype(np.int64), first) for x in n]
        seen[c] = True
        for f in FOLDS:
            k[f] += np.bincount(c[first], m[f] > 0, len(hashes)).astype(np.int64)
        tally += [t for x in (*n, *m) for t in _tally(x)]
    words = np.flatnonzero(seen)
    size = len(words) + 1
    last = np.arange(size) == size - 1
    return pa.Table.from_arrays(
        [pa.array([lang] * size, pa.string()), pa.array([bucket] * size, pa.int32()),
         pa.array(np.append(hashes[words].view(np.int64), 0), mask=last), *[pa.array(np.append(x[words], 0), mask=last) for x in k],
         pa.array([None] * (size - 1) + [tally.tolist()], pa.list_(pa.int64()))], names=["lang", "bucket", "c", "n0", "n1", "tally"])


def _discounts(t: list[int]) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and more, from the numbers of grams that occur one to
    four times (modified Kneser-Ney, 1/2 where they are missing)."""
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * t[0] / (t[0] + 2 * t[1]) * t[k] / t[k - 1] if t[0] and t[1] and t[k - 1] else -1.0
        out.append(d if 0 < d < k else 0.5)
    return np.array(out)


def _shares(n: np.ndarray, t: list[int], context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of grams that occur n times: the discounted share of their context, and the weight of the
    context's lower order (1 if it does not occur)."""
    cut = _discounts(t)[np.minimum(n, 3)]
    total, freed = np.bincount(context, n), np.bincount(context, cut)
    some = np.maximum(total, 1)
    own = n - cut
    del cut
    own *= np.where(total > 0, 1 / some, 0.0)[context]
    return own, np.where(total > 0, freed / some, 1.0)[context]


def _scores(table: pa.Table, words: pa.Table) -> pa.Table:
    """Of a bucket: (uid, bits), each document's sum of -log2 of the interpolated probabilities that
    the other fold's model gives its words. `words`: continuation counts of the words c."""
    empty = pa.schema([("uid", pa.int64()), ("bits", pa.float64())]).empty_table()
    if not table.num_rows:
        return empty
    known = table.column("known")[0].as_py()
    hashes, parts = _opened(table)
    by_hash = np.argsort(asked := words.column("c").to_numpy().view(np.uint64))
    place = by_hash[np.searchsorted(asked, hashes, sorter=by_hash) % len(by_hash)]  # those of other words are not used
    ones = [words.column(f"w{f}").to_numpy() for f in FOLDS]
    total = 0
    for grams, more in parts:
        uids, who = _numbered(np.concatenate([np.cumsum(x[2].astype(np.uint64)) for x in more]))  # the same in all parts
        ends = np.cumsum([len(x[2]) for x in more])
        who = np.concatenate([who[end - len(x[2]):end][x[0]] for end, x in zip(ends, more)])
        fold = np.concatenate([x[3][x[0]] for x in more])
        count = np.concatenate([x[1] for x in more])
        a, b, c = grams
        del more, grams
        order = _order(b, c, a)  # one array after another: a frequent word's part is large
        a = a[order]
        b = b[order]
        c = c[order]
        who = who[order]
        fold = fold[order]
        count = count[order]
        del order
        total += np.bincount(who, _bits(a, b, c, [n[place] for n in ones], fold, count, known), len(uids))
    return pa.Table.from_arrays([pa.array(uids.view(np.int64)), pa.array(total)], names=["uid", "bits"])


def _bits(a: np.ndarray, b: np.ndarray, c: np.ndarray, ones: list[np.ndarray], fold: np.ndarray, count: np.ndarray,
          known: list[int]) -> np.ndarray:
    """-log2 of the probabilities of trigrams (sorted by b, c, a; all of their b), times their count;
    `ones`: the continuation counts of all words in each fold."""
    t3, t2, t1 = ([known[8 * k + 4 * f:8 * k + 4 * f + 4] for f in FOLDS] for k in (0, 1, 2))
    first = _starts(b, c, a)
    gram = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(np.append(first, len(a))))
    a, b, c = a[first], b[first], c[first]
    context = _numbered(a.astype(np.int64) * len(ones[0]) + b)[1]
    two = _starts(b, c)
    short = np.repeat(np.arange(len(two), dtype=np.int32), np.diff(np.append(two, len(a))))
    bits = np.zeros(len(gram))
    for f in FOLDS:
        total, seen = known[24 + 2 * f:26 + 2 * f]
        one, cut = ones[f][c[two]], _discounts(t1[f])
        freed = cut[1] * t1[f][0] + cut[2] * t1[f][1] + cut[3] * (seen - t1[f][0] - t1[f][1])
        p = (one - cut[np.minimum(one, 3)]) / total + freed / total / (seen + 1) if total else np.ones(len(one))
        n = np.add.reduceat(np.where(fold == f, count, 0), first, dtype=np.int64)
        for grams, t, group, lower in ((np.add.reduceat((n > 0).astype(np.int64), two), t2[f], b[two], slice(None)), (n, t3[f], context, short)):
            own, back = _shares(grams, t, group)
            back *= p[lower]
            own += back
            p = own
        del n, own, back
        np.log2(p, out=p)
        unread = fold != f
        bits[unread] = -p[gram[unread]]
    bits *= count
    return bits


def count_words(rows: DataFrame, buckets: int = 64) -> DataFrame:
    """(lang, a, b, c, n0, n1): trigrams of all `rows` (lang, text) as rows, with their count in each fold."""
    def listed(table: pa.Table) -> pa.Table:
        hashes, parts = _opened(table)
        lang, out = table.column("lang")[0].as_py(), []
        for part in parts:
            grams, n = _counted(*part)
            out.append(pa.Table.from_arrays([pa.array([lang] * len(n[0]), pa.string()), *[pa.array(hashes[x].view(np.int64)) for x in grams],
                                             *map(pa.array, n)], names=["lang", "a", "b", "c", "n0", "n1"]))
        return pa.concat_tables(out)

    return _blocks(rows, buckets, 1, 0, False).groupBy("lang", "bucket") \
        .applyInArrow(listed, "lang string, a long, b long, c long, n0 long, n1 long")


def _staged_slices(slices: Iterator[DataFrame], name: str) -> tuple[DataFrame, list[str]]:
    """The slices staged one after another, as one frame, and their folders."""
    held, folders = [], []
    for x in slices:
        folders.append(f"{shared_folder(x.sparkSession, name)}/table")
        x.write.parquet(folders[-1])
        held.append(x.sparkSession.read.schema(x.schema).parquet(folders[-1]))
    return reduce(DataFrame.unionByName, held), folders


def bucket_count(n_words: int) -> int:
    """Buckets of each language, when the largest has n_words."""
    both = math.lcm(COUNT_SLICES, SLICES, LEAST_BUCKETS)
    return both * max(1, math.ceil(n_words / BUCKET_WORDS / both))


def document_bits(rows: DataFrame, n_words: int) -> DataFrame:
    """(uid, bits): per row of `rows` (uid, lang, text) with words, the sum over them of -log2 of
    their probability in the model of the other fold. `n_words`: of the language that has most."""
    buckets = bucket_count(n_words)
    asked, folders = _staged_slices((_blocks(rows, buckets, COUNT_SLICES, k, False).groupBy("lang", "bucket").applyInArrow(
        _continued, "lang string, bucket int, c long, n0 long, n1 long, tally array<long>") for k in range(COUNT_SLICES)), "asked")
    words, _ = _staged_slices((asked.where(F.pmod("c", F.lit(WORD_SLICES)) == k).groupBy("lang", "c").agg(
        *[F.sum(f"n{f}").alias(f"w{f}") for f in FOLDS], F.collect_list("bucket").alias("buckets")) for k in range(WORD_SLICES)), "words")
    tally = asked.where("c IS NULL").groupBy("lang").agg(F.array(*[F.sum(F.col("tally")[k]) for k in range(16)]).alias("t"))
    singles = words.groupBy("lang").agg(F.array(
        *[F.count_if(F.col(f"w{f}") == k) for f in FOLDS for k in (1, 2, 3, 4)],
        *[x for f in FOLDS for x in (F.sum(f"w{f}"), F.count_if(F.col(f"w{f}") > 0))]).alias("u"))
    known = _per_language(tally.join(singles, "lang").select("lang", F.concat("t", "u").alias("known")))
    for folder in folders:  # every word now has its buckets with it
        delete_folder(rows.sparkSession, folder)

    def scores(k: int) -> DataFrame:
        here = F.filter("buckets", lambda x: x % SLICES == k)
        wanted = words.select("lang", F.explode(here).alias("bucket"), "c", "w0", "w1")
        blocks = _blocks(rows, buckets, SLICES, k, True).join(known, "lang")
        return blocks.groupBy("lang", "bucket").cogroup(wanted.groupBy("lang", "bucket")).applyInArrow(_scores, "uid long, bits double") \
            .groupBy("uid").agg(F.sum("bits").alias("bits"))

    return _staged_slices((scores(k) for k in range(SLICES)), "bits")[0].groupBy("uid").agg(F.sum("bits").alias("bits"))


def judge_words(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Per row of `docs` (doc_id, text, lang): doc_id, the base counts, base_failed,
    perplexity (per word), its language's bands low and high, and kept."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    rows = with_uid(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), lang.alias("lang")),
                    ["doc_id", "text", "lang"])
    with _shuffles_deleted(docs.sparkSession):
        return _judged(rows, low, high)


def _judged(rows: DataFrame, low: float, high: float) -> DataFrame:
    base = stage(base_table(rows).join(rows.select("uid", "doc_id", "lang"), "uid"), "base")
    most = base.groupBy("lang").agg(F.sum("n_words").alias("n")).agg(F.max("n")).first()[0] or 0
    measured = base.join(document_bits(rows, most), "uid", "left").withColumn("bits", F.col("bits") / F.col("n_words"))
    n = F.col("n_words")
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n)
    known = stage(measured.withColumn("base_failed", failed), "scored")
    bands = known.where("NOT base_failed AND bits IS NOT NULL").groupBy("lang") \
        .agg(F.percentile_approx("bits", [low, high], 10_000).alias("q"))
    bands = bands.select("lang", *[F.col("q")[k].alias(f"band{k}") for k in (0, 1)])
    return known.join(_per_language(bands), "lang", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("bits").between(F.col("band0"), F.col("band1")), F.lit(False))).alias("kept"),
        F.pow(2.0, "bits").alias("perplexity"), F.pow(2.0, "band0").alias("low"), F.pow(2.0, "band1").alias("high"))
