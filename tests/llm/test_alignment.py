"""Alignment of two tokenizations against brute force over byte offsets."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from corpusgrams.llm import alignment as A
from corpusgrams.llm.packed import pack_numbers, unpack_numbers
from corpusgrams.llm.queries import QUERIES

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD = ["<|endoftext|> <s> </s> ▁ x", "▁", "a▁b", "x" * 3000, "1 " * 3000, " " * 900, "\n" * 900 + "é", "日本語 😀 à",
       "a\x00b \x1c c\x85d", None, "", " ", "\t", "  a  b\n\n c", "​﻿", " 　x", "\x7f؀ ก", "don't 'S <0x41> <unk>"]


def mixtures(n, seed):
    r = random.Random(seed)
    parts = ["a", "é", " ", "\n", "don't", "123", "…", "日", "😀", "▁", "<0x41>", "<unk>", "\t", "'s", "—", "ation", "Ünder"]
    return ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(n)]


@pytest.fixture(scope="module")
def brute():
    """texts -> per text (n_a, n_b, groups as written, list of linked id pairs)."""
    library = tokenizers.Tokenizer.from_file(BYTES)
    library.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    entry = {i: t for t, i in library.get_vocab().items()}
    of = A.byte_level_alphabet()
    piece = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
             for i in range(sp.get_piece_size())]

    def align(texts):
        out = []
        for t in texts:
            ids_a = library.encode(" " + t, add_special_tokens=False).ids if t else []
            ids_b = sp.encode(t) if t else []
            a, b = [bytes(of[c] for c in entry[i]) for i in ids_a], [piece[i] for i in ids_b]
            if not t or b"".join(a) != b" " + t.encode() or b"".join(b) != b" " + t.encode():
                out.append((0, 0, [], []))
                continue
            ends_a, ends_b = np.cumsum([len(x) for x in a]).tolist(), np.cumsum([len(x) for x in b]).tolist()
            groups, links, i, j = [], [], 0, 0
            for cut in sorted(set(ends_a) & set(ends_b)):
                i0, j0 = i, j
                while i < len(a) and ends_a[i] <= cut:
                    i += 1
                while j < len(b) and ends_b[j] <= cut:
                    j += 1
                groups.append((ids_a[i0:i], ids_b[j0:j]))
                links += [(ids_a[x], ids_b[y]) for x in range(i0, i) for y in range(j0, j)
                          if max(ends_a[x] - len(a[x]), ends_b[y] - len(b[y])) < min(ends_a[x], ends_b[y])]
            out.append((len(a), len(b), groups, links))
        return out

    return align


def digest(groups):
    text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def expected_rows(ids, texts, brute):
    found = brute(texts)
    count = Counter(p for *_, links in found for p in links)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(i, n_a, n_b, len(groups), len(links), sum(count[p] == top[p[1]] for p in links),
             sum(count[p] for p in links), digest(groups)) for i, (n_a, n_b, groups, links) in zip(ids, found)]


def key(r):
    return tuple((v is None, 0 if v is None else v) for v in r)


def test_shared_cuts_are_the_common_ends():
    r = random.Random(5)
    for _ in range(300):
        ends_a, ends_b, last, at = [], [], [], 0
        for _ in range(r.randrange(1, 6)):
            n = r.randrange(1, 60)
            ends_a += sorted({at + r.randint(1, n) for _ in range(r.randrange(1, 30))} | {at + n})
            ends_b += sorted({at + r.randint(1, n) for _ in range(r.randrange(1, 30))} | {at + n})
            last.append(len(ends_a) - 1)
            at += n
        cuts = A.shared_cuts(np.array(ends_a), np.array(ends_b), np.array(last))
        assert [ends_a[c] for c in cuts] == sorted(set(ends_a) & set(ends_b))


def test_a_long_text_without_inner_cuts():
    n = 200_000
    ends_a, ends_b = np.arange(1, n + 1) * 2, np.append(np.arange(1, n) * 2 - 1, 2 * n)
    assert A.shared_cuts(ends_a, ends_b, np.array([n - 1])).tolist() == [n - 1]


def test_tokens_are_the_libraries_and_groups_spell_the_text(spark, brute):
    texts = ODD + mixtures(300, 2)
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, a_ids string")
    rows = {r.doc_id: r for r in A.align_documents(df, BYTES, PIECES).collect()}
    for i, (n_a, n_b, groups, _) in enumerate(brute(texts)):
        r = rows[i]
        assert (len(r.a_ids), len(r.b_ids)) == (n_a, n_b)
        assert r.a_ids == [x for a, _ in groups for x in a] and r.b_ids == [x for _, b in groups for x in b]
        assert (r.a_lengths, r.b_lengths) == ([len(a) for a, _ in groups], [len(b) for _, b in groups])


def test_query_matches_brute_force(spark, sf, docs, brute):
    rows = docs.select("doc_id", "text").collect()
    want = expected_rows([r.doc_id for r in rows], [r.text for r in rows], brute)
    got = [tuple(r) for r in QUERIES["op11_alignment"](spark, sf).collect()]
    assert sorted(got) == sorted(want)


def test_edge_rows_match_brute_force_in_any_partitioning(spark, edge, nothing, brute):
    odd = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    df = edge.unionByName(odd, allowMissingColumns=True)
    rows = df.select("doc_id", "text").collect()
    want = sorted(expected_rows([r.doc_id for r in rows], [r.text for r in rows], brute), key=key)
    for n in (1, 5):
        got = [tuple(r) for r in A.alignment_counts(df.repartition(n), BYTES, PIECES).collect()]
        assert sorted(got, key=key) == want
    assert A.alignment_counts(nothing, BYTES, PIECES).count() == 0
    assert A.align_documents(nothing, BYTES, PIECES).count() == 0


def test_stretches_are_the_text_without_inner_blanks():
    for t in [x for x in ODD if x] + mixtures(500, 3):
        parts = A.stretches(t)
        assert " ".join(parts) == t
        assert all(parts[i][-1:].strip() and parts[i + 1][:1].strip() for i in range(len(parts) - 1))


def test_small_blocks_give_the_same(spark, docs, brute, monkeypatch):
    texts = [r.text for r in docs.limit(20).collect()] + ODD
    a, b = A._vocabularies(BYTES, PIECES)
    whole, one = A.Block(texts, a, b), [A.Block([t], a, b) for t in texts]
    assert whole.digests(51_000) == [x.digests(51_000)[0] for x in one]
    assert whole.total(whole.stretch_links).tolist() == [int(x.total(x.stretch_links)[0]) for x in one]


def test_packed_numbers_come_back():
    for x in ([], [0], [5, 70_000, 2**32 - 1, 0]):
        assert unpack_numbers(pack_numbers(np.array(x, np.int64)), len(x)).tolist() == x
