"""Reply trees, token alignment and spelling variants against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quire.llm import alignment, registry, reply_trees, spelling

# --- spelling variants ---------------------------------------------------------


def one_edit(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) - len(u) == 1 and any(v[:i] + v[i + 1:] == u for i in range(len(v)))


def brute_variants(counts, ratio=10):
    near = {u: [v for v in counts if one_edit(u, v)] for u in counts}
    form = {}
    for u in counts:
        best = min(near[u], key=lambda v: (-counts[v], v), default=None)
        form[u] = best if best is not None and counts[best] >= ratio * counts[u] else None
    out = []
    for u in counts:
        root = u
        while form[root] is not None:
            root = form[root]
        out.append((u, form[u], root, counts[u], len(near[u]), counts[form[u]] if form[u] else None))
    return sorted(out)


def made_words():
    rng = random.Random(1)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))) for _ in range(500)}
    words |= {"longer" + w for w in list(sorted(words))[:60]} | {"z" * 300, "z" * 301, "z" * 150 + "y" + "z" * 150}
    return {w: rng.choice([1, 2, 10, 100, 1000]) for w in sorted(words)}


@pytest.mark.parametrize("bound", [10_000, 25, 1])
def test_variants_equal_brute_force_at_every_part_size(spark, bound):
    counts = made_words()
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(words, bound=bound).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got)) == brute_variants(counts)
    pairs = sorted(map(tuple, spelling.near_pairs(words, bound).collect()))
    assert pairs == sorted((u, v) for u in counts for v in counts if one_edit(u, v))


def test_parts_are_bounded_and_a_shared_prefix_is_one_step(spark):
    words = spark.createDataFrame([("same-beginning" + w, 1) for w in made_words()], "word string, n long")
    parts = spelling.initial_states(words, 25)
    assert max(r["count"] for r in parts.groupBy("head", "k").count().collect()) <= 25
    assert parts.where("exists(cuts, c -> c < 14)").count() == 0
    assert spelling.variants(words.limit(0)).count() == 0


def test_acceptor_is_minimal_and_ranks_words():
    words = sorted({"tap", "taps", "top", "tops", "stop", "stops", "st"})
    v = spelling.Acceptor(words)
    right = set()
    for q in range(len(v.final)):  # no two states accept the same endings
        row, arc = v.arcs(np.array([q]))
        right.add((bool(v.final[q]), *zip(v.label[arc], v.target[arc])))
    assert len(right) == len(v.final)
    for rank, word in enumerate(words):
        q, total = v.root, 0
        for c in word:
            (arc,) = v.step(np.array([q]), np.array([ord(c)]))
            total, q = total + v.skip[arc], v.target[arc]
        assert v.final[q] and total == rank


def test_document_words_drop_a_character_by_the_crc(spark):
    rng = random.Random(2)
    texts = [None, "", "Éclair×÷ÿ short", "A" * 5000] + [
        " ".join(rng.choice(["Wonderful", "strasse-ÄÖÜäöüß", "tiny", "Reading9Reading"]) for _ in range(40)) for _ in range(200)]
    rows = [(i if i % 9 else None, t, "x") for i, t in enumerate(texts)]
    want = Counter()
    for d, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    got = spelling.document_words(spark.createDataFrame(rows, "doc_id long, text string, word string")).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}


# --- token alignment -------------------------------------------------------------

ODD = [None, "", " ", "  ", "a", " a", "a ", "  a  b   c ", "a\n b\n\nc \n d", "\n", "\t\tx", "<|endoftext|> </s> <s>[INST]", "a▁b c", "▁",
       "x\x00y", "日本語 テキスト です", "emoji 🤦🏼‍♂️ ok", "naïve café　wide", "A" * 3000, " " * 300 + "x", "x" + " " * 57 + "y",
       "a b c\x85 d\x1c e", "don't they're 12345 3.14 !!! ...", "a b\ta  b", "\r\n x \r\n", "the cat", "the cat"]


def brute_alignment(rows):
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    held, found = Counter(), []
    for doc, text in rows:
        a, b = (tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        one, two = [ranks[i] for i in a], [piece(i) for i in b]
        if not text or not b"".join(one) == b"".join(two) == (" " + text).encode():
            found.append((doc, [], [], []))
            continue
        ends = [{sum(map(len, x[:i + 1])): i + 1 for i in range(len(x))} for x in (one, two)]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            groups.append((a[i:ends[0][end]], b[j:ends[1][end]]))
            i, j = ends[0][end], ends[1][end]
        found.append((doc, a, b, groups))
        held.update({(x, y) for g, h in groups for x in g for y in h})
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for doc, a, b, groups in found:
        links = [(x, y) for g, h in groups for x in g for y in h]
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((doc, len(a), len(b), len(groups), len(links), sum(held[p] == top[p[0]] for p in links),
                    sum(held[p] for p in links), text))
    return sorted(out, key=str), held


@pytest.mark.parametrize("chunking", [{}, {"batch_chars": 200, "chunk_chars": 900}])
def test_alignment_equals_brute_force(spark, chunking):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(" \n\tabcé.'1<0x0A>") for _ in range(rng.randint(1, 60))) for _ in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "  "), (None, "the cat")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, chunk int").repartition(3)
    want, held = brute_alignment(rows)
    assert sum(r[1] > 0 for r in want) > 60
    assert sorted(map(tuple, alignment.align(docs, **chunking).collect()), key=str) == want
    digest = {(r[0], r[7]) for r in map(tuple, alignment.align(docs, digest=True, **chunking).collect())}
    assert digest == {(r[0], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in want}
    assert {(r.a, r.b): r.docs for r in alignment.linked_ids(docs).collect()} == held
    assert alignment.align(docs.limit(0)).count() == 0


def test_long_slices_count_equal_ids_first(monkeypatch):
    monkeypatch.setattr(alignment, "SLICE_LINKS", 1)
    tool = alignment.Aligner(alignment.default_tokenizer(), alignment.default_pieces())
    got = tool.batch(["日本日本 🤦🤦🤦 the cat"])
    monkeypatch.setattr(alignment, "SLICE_LINKS", 4096)
    plain = alignment.Aligner(alignment.default_tokenizer(), alignment.default_pieces()).batch(["日本日本 🤦🤦🤦 the cat"])
    assert got["groups"] == plain["groups"] and (got["pair"] == plain["pair"]).all() and (got["n"] == plain["n"]).all()


# --- reply trees -------------------------------------------------------------------

CONTROLS = "".join(reply_trees.CONTROL) + "\\"


def test_escape_is_reversible_and_leaves_no_control_string():
    rng = random.Random(4)
    bits = [*reply_trees.CONTROL, "\\", "<", "[", ">", "]", "|", "/", "s", "<|", "\n", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))
        safe = reply_trees.escape(text)
        assert reply_trees.unescape(safe) == text
        assert not any(c in safe for c in reply_trees.CONTROL)


def made_messages():
    rng = random.Random(5)
    rows = [(t, i, rng.choice([None, *range(i)]) if i else None, rng.choice(["user", "assistant", None]), f"t{t} m{i} </s>\\ <|end|>",
             rng.choice([None, 1.0, 2.0, -1.0])) for t in (1, 2, None) for i in range(30)]
    rows += [(6, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(70)]  # a deep branch
    rows += [(3, 1, 2, "user", "cycle", 9.0), (3, 2, 1, "user", "cycle", 9.0), (3, 3, 1, "user", "below", 9.0)]
    return rows + [(4, 1, 99, "user", "orphan", 1.0)] * 2 + [(5, None, None, "user", "no id", 1.0)]


def brute_branches(rows, keep):
    out = []
    for tree in {r[0] for r in rows}:
        byid = {r[1]: r for r in rows if r[0] == tree and r[1] is not None}
        parents, paths = {r[2] for r in byid.values()}, []
        for leaf in byid.keys() - parents:
            path, at = [], leaf
            while at in byid and at not in path:
                path.append(at)
                at = byid[at][2]
            if at not in path:
                paths.append((-sum(byid[x][5] or 0 for x in path), leaf, path[::-1]))
        for rank, (score, leaf, path) in enumerate(sorted(paths)[:keep], 1):
            out += [(tree, leaf, rank, -score, place, i, byid[i][4]) for place, i in enumerate(path)]
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", [1, 2, None])
def test_branches_equal_brute_force(spark, keep):
    rows = made_messages()
    df = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")
    got = reply_trees.branches(df, keep).select("tree", "leaf_id", "branch_rank", "branch_score", "place", "id", "text").collect()
    assert sorted(map(tuple, got), key=str) == brute_branches(rows, keep)


@pytest.mark.parametrize("part_chars", [1, 100, 1_000_000])
def test_conversations_come_back_from_their_parts(spark, part_chars):
    rows = [(1, 2, "assistant", CONTROLS), (1, 1, "user", None), (1, 3, "assistant", "é🤦" * 200), (2, 1, None, ""), (None, 1, "assistant", "x"),
            (None, None, "user", "first"), (3, 1, "<|says|>", "tie b"), (3, 1, "<|says|>", "tie a"), (3, 1, "<|says|>", "tie a"),
            *[(4, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(150)]]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, tree int").repartition(3)
    got = {r.conv_id: r for r in reply_trees.conversation_digests(df, part_chars).collect()}
    low = lambda x: (x is not None, x)
    for conv in {r[0] for r in rows}:
        said = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=lambda r: tuple(map(low, r[1:])))]
        learned = "".join(t for r, t in said if r == "assistant")
        row = got.pop(conv)
        assert row.n_turns == len(said) and row.loss_chars == len(learned)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learned.encode()).hexdigest()
        assert row.formatted_chars == sum(len(reply_trees.TURN + reply_trees.escape(r) + reply_trees.SAYS + reply_trees.escape(t)
                                              + reply_trees.END) for r, t in said)
    assert not got
    assert reply_trees.conversation_digests(df.limit(0)).count() == 0


def test_added_conversation_is_read_back(spark):
    rows = {r.conv_id: r for r in registry.QUERIES["op11_reply_trees"](spark, "/root/testdata/sf0.001").collect()}
    text = registry.CONVERSATION_7[0][3]
    assert rows[-7].n_turns == 2 and rows[-7].loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
