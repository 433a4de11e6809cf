"""Licences, personal data, chat, tokens and packing against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from re import _parser as parser

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from corpusgrams.llm import licenses as L
from corpusgrams.llm import packing as K
from corpusgrams.llm import pii as P
from corpusgrams.llm import reply_trees as T
from corpusgrams.llm.agenda import merge_all, merge_one
from corpusgrams.llm.piece_codec import PieceCodec, encode_documents
from corpusgrams.llm.queries import ORACLES, QUERIES
from tools.check_oracles import rows_of

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, texts):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "w", 1, "k") for i, t in enumerate(texts)],
                                 "doc_id long, text string, words string, base int, personal_spans string")


def mixtures(parts, n, size, seed, glue=""):
    r = random.Random(seed)
    return [glue.join(r.choice(parts) for _ in range(r.randrange(size))) for _ in range(n)]


# --- personal data ---------------------------------------------------------------


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0


def digits(s):
    return re.sub("[^0-9]", "", s)


BASE_RULES = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(x) <= 255 for x in s.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= len(digits(s)) <= 15),
)


def base_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, rx, ok in BASE_RULES for m in re.finditer(rx, text or "") if ok(m.group())]


ODD_PII = mixtures(
    ["a", "b.c", "@", "x.y", "_", "1", "2", ".", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "192.168.1.1", "255",
     "é", "😀", "\n", "DE89370400440532013000", " ssn 123-45-6789 ", "+1 (555) 123-4567", "%"], 600, 30, 2) + [
    "a.b@c.d_e@f.g", "1.2.3.4.5.6.7.8", "x" * 9000 + "@", "1" * 9000, "1 " * 20_000, "a@b" + ".c" * 9000, None, "",
    "version 1.2.3.4", "256.1.1.1", "000000000000000000001.2.3.4"]


def test_base_spans_match_brute_force(spark, docs):
    for df in (frame(spark, ODD_PII), docs):
        texts = {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
        for r in P.find_personal_data(df).collect():
            got = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in P.BASE_KINDS]
            assert got == base_spans(texts[r.doc_id])
            assert all(0 <= s.score <= 1 for s in r.spans)


def test_added_kinds_need_their_checks(spark):
    texts = ["my iban DE89370400440532013000 ok", "DE89370400440532013001", "ssn 123-45-6789", "123-45-6789",
             "social security 000-45-6789", "GB82WEST12345698765432", "xDE89370400440532013000"]
    got = {r.doc_id: [s.kind for s in r.spans] for r in P.find_personal_data(frame(spark, texts)).collect()}
    assert got == {0: ["iban"], 1: [], 2: ["ssn"], 3: [], 4: [], 5: ["iban"], 6: []}


def test_context_moves_the_score(spark):
    texts = ["visa card 4111111111111111", "4111111111111111", "invoice 4111111111111111"]
    score = {r.doc_id: r.spans[0].score for r in P.find_personal_data(frame(spark, texts)).collect()}
    assert score[0] > score[1] > score[2]


def test_redaction(spark, edge, nothing):
    texts = ["write a.b@c.de now", "clean", None, "a@b.c 10.0.0.1", "card 4111 1111 1111 1111 x"]
    df = frame(spark, texts)
    out = P.redact(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] == "write <EMAIL> now" and got[1] == "clean" and got[2] is None and got[3] == "<EMAIL> <IP>"
    assert got[4] == "card <CARD> x"
    assert P.redact(edge).schema == edge.schema and P.redact(edge).count() == edge.count()
    assert P.redact(nothing).count() == 0 and P.find_personal_data(nothing).count() == 0
    again = P.find_personal_data(P.redact(frame(spark, ODD_PII[600:]))).collect()
    assert not any(s.kind == "email" for r in again for s in r.spans)


def test_op6_digests(spark, sf, docs):
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in QUERIES["op6_pii"](spark, sf).collect():
        want = base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in P.BASE_KINDS]
        assert set(want) <= set(r.spans.split(","))


# --- licences ---------------------------------------------------------------------


def license_brute(text):
    low = (text or "").translate({i: i + 32 for i in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for phrase, label in L.BASE.items():
        p = phrase.split()
        hits = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    line = " " + "".join(x + " " for x in w)
    found = sorted((m.start(), -m.end(), -prio, label, sure) for label, prio, sure, key, rx in L.rules()
                   if key in line and any(s in line for s in L.STEMS) for m in re.finditer(rx, line))
    kept = [d for n, d in enumerate(found) if not any(e[1] <= d[1] and e[2] <= d[2] for e in found[:n])]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {d[3] for d in kept})), max([1.0 * bool(labels)] + [d[4] for d in kept]))


def test_license_scan_matches_brute_force(spark, sf, docs, edge, nothing, monkeypatch):
    parts = ["Licensed", "under", "the", "MIT", "License", "Apache", "Version", "2", "0", "CC", "BY", "NC", "cc-by-nc-sa 4.0",
             "GPL", "v3", ",", "-", "\n", "é", "İ", "SPDX-License-Identifier: MIT", "GNU General Public License, version 3",
             "all rights reserved", "released under", "\x00"]
    odd = frame(spark, mixtures(parts, 400, 25, 3, " ") + [
        None, "", " ", "cc by nc " * 2000, "x" * 50_000, "under the mit license under the mit license", "CC-BY-NC"])
    for df in (odd, docs, edge):
        monkeypatch.setattr(L, "documents", lambda s, d, df=df: df)
        got = Counter(tuple(r) for r in L.op5_licenses(spark, sf).collect())
        assert got == Counter((r.doc_id, *license_brute(r.text)) for r in df.collect())
    assert L.scan(nothing).count() == 0


def test_there_are_hundreds_of_rules_with_their_keywords():
    assert len(L.rules()) > 300
    assert all(1 <= prio <= 8 and 0 < sure <= 1 for _, prio, sure, _, _ in L.rules())


def forms_of(parsed):
    """Every string that a parsed pattern without unbounded repeats matches."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            some = [chr(arg)]
        elif name == "IN":
            some = [chr(c) for _, c in arg]
        elif name == "BRANCH":
            some = [x for branch in arg[1] for x in forms_of(branch)]
        elif name == "SUBPATTERN":
            some = forms_of(arg[-1])
        elif name == "MAX_REPEAT":
            assert arg[:2] == (0, 1)
            some = ["", *forms_of(arg[2])]
        else:
            assert name == "ASSERT"
            some = [" "]
        out = [a + b for a in out for b in some]
    return out


def test_each_license_rule_implies_its_keyword():
    for label, _, _, keyword, pattern in L.rules():
        for line in forms_of(parser.parse(pattern)):
            assert re.match(pattern, line) and keyword in line, (label, keyword, line)


def test_each_license_rule_implies_a_stem(spark):
    for label, _, _, _, pattern in L.rules():
        for line in forms_of(parser.parse(pattern)):
            assert any(stem in line for stem in L.STEMS), (label, line)
    texts = {"this code is covered by the GPL v3": "gpl-3", "governed by the MPL 2.0": "mpl-2", "covered by MIT": "mit",
             "governed by the EPL 2.0": "epl-2", "available by the terms of the ISC": "isc"}
    for r in L.scan(frame(spark, list(texts))).collect():
        assert [d.label for d in r.detections] == [list(texts.values())[r.doc_id]]


def test_license_names_and_codes_without_a_common_keyword(spark):
    texts = {"SPDX-License-Identifier: MS-PL": "ms-pl", "SPDX-License-Identifier: GFDL-1.3": "gfdl",
             "SPDX-License-Identifier: UPL-1.0": "upl-1", "SPDX-License-Identifier: MS-RL": "ms-rl",
             "SPDX-License-Identifier: PSF-2.0": "python-2", "licensed under Creative Commons Attribution 4.0": "cc-by",
             "licensed under CC BY 4.0": "cc-by"}
    for r in L.scan(frame(spark, list(texts))).collect():
        assert [d.label for d in r.detections] == [list(texts.values())[r.doc_id]]


def test_license_scan_matches_rules_without_gates(spark, sf, docs, monkeypatch):
    parts = [code for lic in L.LICENSES for code in (lic[3].split("(")[0].replace("[", "").replace("]", ""), lic[1])]
    parts += ["SPDX-License-Identifier:"] * 30 + ["licensed under", "covered by", "governed by the", "available by", "the", "4.0",
                                                  "Creative Commons Attribution", "Python Software Foundation", "license"] * 5
    odd, rules = frame(spark, mixtures(parts, 600, 12, 9, " ")), [(*r[:3], "", r[4]) for r in L.rules()]
    for df in (odd, docs):
        with monkeypatch.context() as m:
            m.setattr(L, "documents", lambda s, d, df=df: df)
            got = Counter(tuple(r) for r in L.op5_licenses(spark, sf).collect())
            m.setattr(L, "rules", lambda: rules)
            m.setattr(L, "STEMS", ("",))
            assert got == Counter((r.doc_id, *license_brute(r.text)) for r in df.collect())


# --- chat ---------------------------------------------------------------------------


def test_op3_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    df = QUERIES["op3_chat"](spark, sf)
    cur = con.execute(ORACLES["op3_chat"])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


def random_trees(seed=3):
    r, rows = random.Random(seed), []
    for t in range(12):
        for i in range(r.randrange(1, 25)):
            rows.append((f"t{t}", i, None if i == 0 or r.random() < 0.05 else r.randrange(max(0, i - 3), i),
                         r.choice([None, 0.0, 1.0, 2.5]), r.choice(["user", "assistant", None, "a:b#"]),
                         r.choice([None, "", "x\\#<y", "### user: </turn>\n", " é"])))
    rows += [("cycle", 0, 1, 0.0, "user", "a"), ("cycle", 1, 0, 0.0, "user", "b"), ("orphan", 0, 7, 0.0, "user", "z")]
    return rows + [("long", i, i - 1 if i else None, 0.0, "assistant", str(i)) for i in range(40)]


def tree_brute(rows):
    trees, out = defaultdict(dict), {}
    for r in rows:
        trees[r[0]][r[1]] = r
    for t, nodes in trees.items():
        parents, paths = {r[2] for r in nodes.values()}, []
        for i in set(nodes) - parents:
            path = [i]
            while nodes[path[-1]][2] in nodes:
                path.append(nodes[path[-1]][2])
            if nodes[path[-1]][2] is None:
                paths.append((-sum(nodes[j][3] or 0 for j in path) / len(path), -len(path), i, path[::-1]))
        for k, p in enumerate(sorted(paths)):
            out[t, k + 1] = [(nodes[j][4], nodes[j][5]) for j in p[3]]
    return out


def test_branches_match_brute_force(spark):
    rows = random_trees()
    df = spark.createDataFrame(rows, "tree string, node long, parent long, score double, role string, text string")
    want = tree_brute(rows)
    assert {(r.tree, r.branch): [(m.role, m.text) for m in r.messages] for r in T.branch_paths(df, None).collect()} == want
    done = T.format_trees(df, 2)
    back = done.select("tree", "branch", T.read_back(F.col("formatted")).alias("m"),
                       T.learned_text(F.col("formatted"), F.col("loss")).alias("l")).collect()
    assert {(r.tree, r.branch) for r in back} == {k for k in want if k[1] <= 2}
    for r in back:
        turns = [(a or "", b or "") for a, b in want[r.tree, r.branch]]
        assert [(m.role, m.text) for m in r.m] == turns
        assert r.l == "".join(b for a, b in turns if a == "assistant")
    assert T.format_trees(df.limit(0)).count() == 0


def test_conversations_with_nulls_ties_and_repeats(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", None), (1, None, "system", "s"), (2, 0, None, "")]
    df = spark.createDataFrame([(*r, 9) for r in rows] + [(None, 3, "user", "q", 9)],
                               "conv_id long, turn long, role string, text string, node int")
    done = T.format_trees(T.as_trees(df).drop("conv_id"))
    got = {r.tree: [(m.role, m.text) for m in r.m] for r in done.select("tree", T.read_back(F.col("formatted")).alias("m")).collect()}
    assert got == {"1": [("system", "s"), ("user", "a"), ("user", "a"), ("assistant", "")], "2": [("", "")], "none": [("user", "q")]}


# --- pieces --------------------------------------------------------------------------

ODD_TEXTS = ["", " ", "  ", "a", "\n", "a\nb", " a \n\n b ", "▁", "▁▁ ▁", "日本語 梦ゼ", "😀 x😀😀", "\x00a\x01", "a" * 3000,
             "ab " * 2000, "<s> </s> <unk> <0x0A>", "\t\t a\r\n", " " * 40 + "x", "ΑΣ ΑΣ.", "<|endoftext|> x<|startoftext|>"]
ODD_TEXTS += mixtures([" ", "▁", "\n", "a", "t", "h", "e", "in", "'s", "'LL", "é", "É", "日", "😀", "\t", "  ", "<0x41>", "ß",
                       "̀", "\x1c", "\x85", "İ", "1", "½", "!", "K", "ﬁ", "µ"], 800, 50, 1)


def test_pieces_equal_the_library(docs):
    library, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), PieceCodec(PIECES)
    texts = ODD_TEXTS + [r.text for r in docs.select("text").limit(60).collect()]
    ids = codec.encode(texts)
    assert ids == library.encode(texts)
    assert codec.decode(ids) == library.decode(ids)


def test_block_agenda_equals_heap_agenda():
    codec, r = PieceCodec(PIECES), random.Random(4)
    rows = [[codec.symbols.get(c, -1) for c in "".join(r.choice("▁▁theanding日") for _ in range(r.randrange(1, 60)))]
            for _ in range(500)]
    flat, size = merge_all(np.concatenate([np.array(x) for x in rows]), np.array([len(x) for x in rows]), codec.table)
    got = [x.tolist() for x in np.split(flat, np.cumsum(size)[:-1])]
    assert got == [merge_one(x, codec.table) for x in rows]


def test_encode_documents_edge_cases(edge, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter((r.doc_id, tuple(library.encode(r.text or ""))) for r in edge.collect())
    got = encode_documents(edge, PIECES).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert all(r.decoded == library.decode(list(r.ids)) for r in got)
    assert encode_documents(nothing, PIECES).count() == 0


def test_op4_digests(spark, sf, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: r for r in QUERIES["op4_sentencepiece"](spark, sf).collect()}
    for r in docs.select("doc_id", "text").collect():
        ids, g = library.encode(r.text or ""), got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


# --- packing --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(WORDS)


CONTROL_TEXTS = mixtures(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", " ", "a", "é", "日",
                          "̀", "'s", "\n", "1", "İ"], 800, 14, 2)


def test_word_ids_equal_the_library(library, docs):
    texts = ODD_TEXTS + CONTROL_TEXTS + [r.text for r in docs.select("text").limit(60).collect()]
    got = [np.frombuffer(x, "<u4").tolist() for x in K.WordTokens(WORDS).ids(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_a_full_memory_keeps_what_is_in_use():
    m = K.Memory(2)
    for wanted in ("ab", "bc", "ad", "ae"):
        m.turn()
        for k in m.missing(set(wanted)):
            m[k] = k
        assert all(m[k] == k for k in wanted)


def check_pieces(rows, ids_of, size=K.LENGTH):
    """Every id of every document (rows: doc_id, text) lies in exactly one piece."""
    want = Counter()
    documents, sequences = defaultdict(list), defaultdict(list)
    for p in rows:
        documents[p.doc_id].append(p)
        sequences[p.sequence_id].append(p)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= size
        want[at] += 1
    for doc, ids in ids_of.items():  # a list of the id lists of the rows of this doc_id
        pieces = Counter((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in documents.pop(doc))
        assert sum(n * k[1] for k, n in pieces.items()) == sum(map(len, ids))
        for x in ids if len(ids) == 1 else []:
            at = 0
            for start, length, crc, tokens in sorted(pieces):
                assert (start, tokens) == (at, len(x))
                assert crc == zlib.crc32(np.array(x[start:start + length], "<u4").tobytes())
                at += length
    assert not documents
    return want


def test_packing_edge_cases(edge, nothing, library):
    ids = defaultdict(list)
    for r in edge.collect():
        ids[r.doc_id].append(library.encode(r.text or "", add_special_tokens=False).ids + [2])
    fills = check_pieces(K.pack(edge.repartition(5, "uid"), WORDS).collect(), ids)
    assert sum(n for fill, n in fills.items() if fill < K.LENGTH) <= 1
    assert K.pack(nothing, WORDS).count() == 0


def test_op10_pieces(spark, sf, docs, library):
    ids = {r.doc_id: [library.encode(r.text or "", add_special_tokens=False).ids + [2]] for r in docs.collect()}
    fills = check_pieces(QUERIES["op10_packing"](spark, sf).collect(), ids)
    assert sum(n for fill, n in fills.items() if fill < K.LENGTH) <= 1


def test_level_choice_is_the_least_sum_of_squares():
    r = np.random.default_rng(0)
    for _ in range(300):
        p = K.LevelPacker(16)
        p.count[1:16] = r.integers(0, 4, 15)
        n = int(r.integers(1, 17))

        def after(h):
            c = p.count.astype(int).copy()
            if h:
                c[h] -= 1
            if h + n < 16:
                c[h + n] += 1
            return int((c**2).sum())

        able = [h for h in range(17 - n) if h == 0 or p.count[h] > 0]
        best = min(map(after, able))
        assert p.level(n) == max(h for h in able if after(h) == best)
