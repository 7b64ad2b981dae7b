"""Spelling variants: words one edit apart, by finite-state composition.

The vocabulary V is a minimised acyclic acceptor, E a transducer that copies its
input but for exactly one inserted, deleted or replaced character. The accepted
pairs of V o E o V are the pairs of words at one edit. A state of the composition
before its edit is a pair (q, q) of the same state of V twice, so it is named by
the prefix that leads to it. Spark deals the vocabulary out by such initial states:

- a prefix that more than `bound` words share is divided at its next branching
  place (the cut), again and again, until each part has at most `bound` words; a
  prefix that everything has in common is passed in one step;
- within a part a task builds the minimised acceptor of its words and walks the
  composition from the part's initial state, all states of a step at a time;
- a pair whose edit lies at a cut has its words in different parts. Behind the
  edit E only copies, so both words must go on alike: such pairs meet in a
  grouping by the cut and the word without the character at the cut. A group
  holds words that differ in that one character, at most as many as letters.

A pair's edit is taken at the end of its longest common prefix, so each pair is
found exactly once. Tasks hand on sums and bests per word, not pairs; no group of
the vocabulary is gathered beyond `bound` words, and nothing is left out.

Words are compared by code points. Null texts hold no words; a null doc_id counts as
an empty one. Repeated rows count as often as they occur. Texts and words of any
length are read whole. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import stage

RUN = r"[A-Za-z\x{00C0}-\x{00FF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of one part of the vocabulary at most; a task holds the acceptor of one part.
PART_WORDS = 100_000
#: Composed states that a task expands at once.
SLICE = 1_000_000

LINKS = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("near_n", pa.int64()), ("near", pa.string())])
PAIRS = pa.schema([("word", pa.string()), ("near", pa.string())])


# --- words -------------------------------------------------------------------

def document_words(documents: DataFrame, drop_every: int = 31, min_chars: int = 7, min_count: int = 2) -> DataFrame:
    """(word, n): letter runs of the whole texts, A-Z lower-cased, with their
    occurrences. Where `drop_every` divides the crc32 h of `<doc_id>:<run>`, the run
    loses its character h % length. Words below `min_chars` or `min_count` are left out."""
    text = F.translate("text", UPPER, LOWER)
    run = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
                           F.explode(F.regexp_extract_all(text, F.lit(RUN), F.lit(0))).alias("run")) \
        .where(F.char_length("run") >= min_chars)
    h = F.crc32(F.concat_ws(":", "doc", "run"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    word = F.when(F.col("h") % drop_every == 0, without("run", at)).otherwise(F.col("run"))
    return run.withColumn("h", h).select(word.alias("word")).where(F.char_length("word") >= min_chars) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def without(word, place: Column) -> Column:
    """`word` without its character at `place` (from 0)."""
    w = F.col(word) if isinstance(word, str) else word
    return F.concat(w.substr(F.lit(1), place), w.substr(place + 2, F.char_length(w)))


# --- the acceptor --------------------------------------------------------------

class Acceptor:
    """Minimised acyclic acceptor of sorted distinct words as arrays: the arcs of a
    state are arcs[first[q]:first[q + 1]], sorted by label; `skip` of an arc is the
    number of the state's words before those behind the arc, so the sum over a path
    is the rank of its word. State 0 accepts only the empty word or nothing more."""

    def __init__(self, words: list[str]):
        known: dict[tuple, int] = {}
        arcs_of: list[tuple] = []

        def settle(final: bool, arcs: list) -> int:
            """The state with these arcs, made once."""
            key = (final, *arcs)
            q = known.get(key)
            if q is None:
                q = known[key] = len(arcs_of)
                arcs_of.append(key)
            return q

        path: list[list] = [[False, []]]  # the states of the last word's prefixes: (final, arcs); its last arc is open
        last = ""
        for word in words:
            same = 0
            for x, y in zip(last, word):
                if x != y:
                    break
                same += 1
            self._close(path, last, same, settle)
            for _ in range(same, len(word)):
                path.append([False, []])
            path[-1][0] = True
            last = word
        self._close(path, last, 0, settle)
        self.root = settle(path[0][0], path[0][1])

        degree = np.fromiter((len(a) // 2 for a in arcs_of), np.int64, len(arcs_of))
        self.first = np.concatenate([[0], np.cumsum(degree)])
        self.final = np.fromiter((a[0] for a in arcs_of), bool, len(arcs_of))
        flat = [x for a in arcs_of for x in a[1:]]
        self.label = np.fromiter(flat[0::2], np.int64, len(flat) // 2)
        self.target = np.fromiter(flat[1::2], np.int64, len(flat) // 2)
        size, skip = [0] * len(arcs_of), np.zeros(len(self.label), np.int64)
        for q, a in enumerate(arcs_of):  # targets are made before the states that lead to them
            n, i = int(a[0]), self.first[q]
            for j, t in enumerate(a[2::2]):
                skip[i + j] = n
                n += size[t]
            size[q] = n
        self.skip = skip
        self.key = np.repeat(np.arange(len(arcs_of)), degree) << 21 | self.label

    @staticmethod
    def _close(path: list, last: str, keep: int, settle) -> None:
        """Settle the states of `last` beyond its first `keep` characters."""
        for i in range(len(path) - 1, keep, -1):
            final, arcs = path.pop()
            path[-1][1] += [ord(last[i - 1]), settle(final, arcs)]

    def arcs(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, arc) for every arc of `states`."""
        n = self.first[states + 1] - self.first[states]
        row = np.repeat(np.arange(len(states)), n)
        return row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.first[states[row]]

    def step(self, states: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """The arc of each state with that label, or -1."""
        want = states << 21 | labels
        at = np.searchsorted(self.key, want)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == want, at, -1) if len(self.key) else np.full(len(states), -1)


def composed_pairs(v: Acceptor, slice_size: int = SLICE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ranks (i, j) of the word pairs that V o E o V accepts, each pair once.

    `before` holds the composed states (q, q) ahead of the edit with the rank that
    their path has summed up; `after` the states (s, t) behind it with both ranks."""
    before = [(np.array([v.root]), np.array([0]))]
    while before:
        q, rank = before.pop()
        if len(q) > slice_size:
            before.append((q[slice_size:], rank[slice_size:]))
            q, rank = q[:slice_size], rank[:slice_size]
        row, arc = v.arcs(q)
        to, to_rank = v.target[arc], rank[row] + v.skip[arc]
        if len(arc):
            before.append((to, to_rank))
        ends = v.final[q[row]] & v.final[to]  # the edit adds the last character
        if ends.any():
            yield rank[row[ends]], to_rank[ends]
        # one character more on one side: the other side goes on with another label
        r2, a2 = v.arcs(to)
        b2 = v.step(q[row[r2]], v.label[a2])
        ok = (b2 >= 0) & (v.label[a2] != v.label[arc[r2]])
        r2, a2, b2 = r2[ok], a2[ok], b2[ok]
        after = [(v.target[b2], rank[row[r2]] + v.skip[b2], v.target[a2], to_rank[r2] + v.skip[a2])]
        # another character: two different arcs of the same state
        left = (v.first[q + 1])[row] - arc  # arcs of the same state from this one on
        for gap in range(1, int(left.max(initial=0))):
            x = np.flatnonzero(left > gap)
            after.append((to[x], to_rank[x], to[x + gap], to_rank[x + gap]))
            if sum(len(a[0]) for a in after) > slice_size:
                yield from _copied(v, after)
                after = []
        yield from _copied(v, after)


def _copied(v: Acceptor, after: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Follow composed states behind the edit, where both sides read the same labels."""
    if not after:
        return
    s, i, t, j = (np.concatenate(x) for x in zip(*after))
    while len(s):
        both = v.final[s] & v.final[t]
        if both.any():
            yield i[both], j[both]
        row, a = v.arcs(s)
        b = v.step(t[row], v.label[a])
        ok = b >= 0
        row, a, b = row[ok], a[ok], b[ok]
        s, i, t, j = v.target[a], i[row] + v.skip[a], v.target[b], j[row] + v.skip[b]


def _part_pairs(table: pa.Table) -> tuple[list[str], np.ndarray, Iterator]:
    words, counts = table["word"].to_pylist(), table["n"].to_numpy()
    order = sorted(range(len(words)), key=words.__getitem__)
    words = [words[i] for i in order]
    return words, counts[order], composed_pairs(Acceptor(words))


def _part_links(table: pa.Table) -> pa.Table:
    """Per word of a part: its near words there, and the one of largest n (ties: the least)."""
    words, counts, pairs = _part_pairs(table)
    near = np.zeros(len(words), np.int64)
    best = np.full(len(words), -1)
    rank = np.empty(len(words), np.int64)  # least rank: largest n, then the least word
    rank[np.lexsort((np.arange(len(words)), -counts))] = np.arange(len(words))
    word_of = np.argsort(rank)
    found = np.full(len(words), len(words))
    for i, j in pairs:
        near += np.bincount(i, minlength=len(words)) + np.bincount(j, minlength=len(words))
        np.minimum.at(found, i, rank[j])
        np.minimum.at(found, j, rank[i])
    some = np.flatnonzero(near)
    best = word_of[found[some]]
    return pa.table([pa.array([words[k] for k in some], pa.string()), pa.array(near[some]), pa.array(counts[best]),
                     pa.array([words[k] for k in best], pa.string())], schema=LINKS)


def _part_rows(table: pa.Table) -> pa.Table:
    """The accepted pairs of a part themselves, in both directions."""
    words, _, pairs = _part_pairs(table)
    u, w = [], []
    for i, j in pairs:
        u += [words[k] for k in np.concatenate([i, j])]
        w += [words[k] for k in np.concatenate([j, i])]
    return pa.table([pa.array(u, pa.string()), pa.array(w, pa.string())], schema=PAIRS)


# --- initial states -------------------------------------------------------------

def _common_prefix(lo: str, hi: str) -> Column:
    return F.expr(f"size(filter(sequence(0, char_length({lo})), i -> i > 0 AND substring({lo}, 1, i) = substring({hi}, 1, i)"
                  f" AND char_length({hi}) >= i))")


def initial_states(words: DataFrame, bound: int = PART_WORDS) -> DataFrame:
    """(word, n, head, cuts): the prefix that names the word's part, and the places
    at which its parts were cut on the way there. Parts hold at most `bound` words.

    A round finds the parts that are too large (at most |V| / bound rows, a staged
    table that Spark broadcasts if its size allows) and divides them at the place
    where their words first differ."""
    now = words.select("word", "n", F.lit(0).alias("k"), F.expr("CAST(array() AS array<int>)").alias("cuts"))
    while True:
        head = F.col("word").substr(F.lit(1), F.col("k")).alias("head")
        large = stage(
            now.groupBy(head, "k").agg(F.count(F.lit(1)).alias("size"), F.min("word").alias("lo"), F.max("word").alias("hi"))
            .where(F.col("size") > bound).select("head", F.col("k").alias("was"), _common_prefix("lo", "hi").alias("cut")), "cuts")
        if large.isEmpty():
            return now.select("word", "n", head, "k", "cuts")
        at = (F.col("word").substr(F.lit(1), F.col("k")) == F.col("head")) & (F.col("k") == F.col("was"))
        now = stage(now.join(large, at, "left").select(
            "word", "n", F.coalesce(F.col("cut") + 1, F.col("k")).alias("k"),
            F.when(F.col("cut").isNull(), F.col("cuts")).otherwise(F.concat("cuts", F.array("cut"))).alias("cuts")), "parts")


def _cut_groups(parts: DataFrame) -> DataFrame:
    """(members): words that are alike but for the place of a cut; those with a
    character there have it as `c`, the one without (if any) has `gap` set and its
    next character as `c`."""
    at = parts.select("word", "n", F.explode("cuts").alias("cut"))
    here = F.col("word").substr(F.col("cut") + 1, F.lit(1)).alias("c")
    skip = at.where(F.char_length("word") > F.col("cut")).select(
        "cut", without("word", F.col("cut")).alias("rest"), F.struct(F.lit(False).alias("gap"), here, "n", "word").alias("m"))
    keep = at.select("cut", F.col("word").alias("rest"), F.struct(F.lit(True).alias("gap"), here, "n", "word").alias("m"))
    return skip.unionByName(keep).groupBy("cut", "rest").agg(F.collect_list("m").alias("members")) \
        .where(F.size("members") > 1)


def _cut_near(parts: DataFrame) -> DataFrame:
    """(x, near): each member of a cut's group with the members that are one edit away at the cut."""
    return _cut_groups(parts).select(F.explode("members").alias("x"), "members").select(
        "x", F.filter("members", lambda m: (m["c"] != F.col("x.c")) & ~(m["gap"] & F.col("x.gap"))).alias("near")) \
        .where(F.size("near") > 0)


def near_words(words: DataFrame, bound: int = PART_WORDS) -> DataFrame:
    """(word, n_near, near_n, near) for the words of (word, n) that have a near word:
    how many words are at one edit, and of them the one of largest n (ties: the least)."""
    parts = stage(initial_states(words, bound), "states")
    inside = parts.groupBy("head", "k").applyInArrow(_part_links, "word string, n_near long, near_n long, near string")
    best = F.array_min(F.transform("near", lambda m: F.struct((-m["n"]).alias("order"), m["word"].alias("word"))))
    across = _cut_near(parts).select(F.col("x.word").alias("word"), F.size("near").cast("long").alias("n_near"), best.alias("b")) \
        .select("word", "n_near", (-F.col("b.order")).alias("near_n"), F.col("b.word").alias("near"))
    both = inside.unionByName(across)
    return both.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near"))).alias("b")) \
        .select("word", "n_near", (-F.col("b.order")).alias("near_n"), F.col("b.near").alias("near"))


def near_pairs(words: DataFrame, bound: int = PART_WORDS) -> DataFrame:
    """(word, near): all pairs of words at one edit, in both directions."""
    parts = stage(initial_states(words, bound), "states")
    inside = parts.groupBy("head", "k").applyInArrow(_part_rows, "word string, near string")
    across = _cut_near(parts).select(F.col("x.word").alias("word"), F.explode("near.word").alias("near"))
    return inside.unionByName(across)


def variants(words: DataFrame, ratio: int = 10, bound: int = PART_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of `words` (word, n; words
    distinct): `form` is the near word of largest n if that is at least `ratio`
    times the word's own, `root` the last word that following forms leads to.

    Forms grow by `ratio` at every step, so chains are short; the followed
    length doubles with every round."""
    words = stage(words.select("word", "n"), "words")
    near = near_words(words, bound)
    is_form = F.col("near_n") >= ratio * F.col("n")
    found = stage(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "forms")
    lead = found.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = lead.select(F.col("word").alias("via"), F.col("root").alias("next"))
        moved = stage(lead.join(on, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        lead = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return found.join(lead, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"),
                                                  "n", "n_near", "form_n")
