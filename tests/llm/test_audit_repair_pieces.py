"""Filter audit, conversation repair and piece encoding against brute force, SQL and the library."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from rimecast.llm import conversation_repair as cr
from rimecast.llm import oracles, piece_encoding
from rimecast.llm.conversation_repair import plan_repairs, repair_conversations, repaired_rows
from rimecast.llm.filter_audit import audit_filters, filter_interactions, mask_cells
from rimecast.llm.piece_encoding import Pieces, decode_pieces, encode_pieces
from rimecast.llm.queries import damaged, tokenizer_file
from tests.compare import check

WORD = re.compile(r"[^\x20\x09-\x0D]+")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


# filter audit


def _labels():
    return [(0, 1, 0), (1, None, 1), (1, 1, None), (2, 0, 1), (2, 1, 0), (5, 1, 1), (30, 1, 0), (31, 1, 1), (47, 1, 0), (None, 1, 1), (999, 1, 1), (45, 0, 1)]


def _audit_rows(rows):
    """The awkward rows, and some that fail each filter."""
    rng = random.Random(3)
    more = []
    for i in range(60):
        words = [rng.choice("alpha beta gamma delta Epsilon ZETA eta theta # 5% iota".split()) + str(rng.randrange(10 if i % 2 else 400)) for _ in range(rng.choice((3, 99, 100, 130)))]
        more.append((1000 + i % 50, " ".join(words).upper() if i % 7 == 0 else " ".join(words), ("en", "de", None, "")[i % 4], "s", 0))
    copies = [(2000 - i, more[0][1], ("en", "xx")[i % 2], "s", 0) for i in range(9)]
    return [*rows, *more, *copies]


def _audit_brute(rows, labels):
    first = {}
    for i, text, *_ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    good, toxic = ({i for i, *v in labels if i is not None and v[k] == 1} for k in (0, 1))
    parts = {}
    for i, text, lang, *_ in rows:
        t = text or ""
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and t in first and first[t] < i,
        }
        parts.setdefault(lang or "", []).append(({k for k, v in fails.items() if v}, i in good, i in toxic))
    out, totals = {}, Counter()
    for part, docs in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(docs)
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                totals[part, f] += len(gone)
                failing = sum(f in d[0] for d in docs)
                out[part, order, step] = (len(left), len(gone), failing - len(gone), sum(d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone))
    return {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


AUDIT = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_filter_audit(spark, rows):
    every = _audit_rows(rows)
    docs, labels = spark.createDataFrame(every, DOCS), spark.createDataFrame(_labels(), "doc_id long, quality int, toxic int")
    # names that clash with those of the operator
    docs = docs.withColumns({c: F.lit("x") for c in ("id", "part", "digest", "bits", "salt", "good", "toxic", "mask", "n", "low", "step")})
    labels = labels.withColumns({c: F.lit(1) for c in ("id", "good", "salt")})
    got = filter_interactions(docs, labels)
    assert got.columns == ["part", "filter_order", "step", *AUDIT]
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in AUDIT) for r in got.collect()} == _audit_brute(every, _labels())
    assert filter_interactions(docs.limit(0), labels).count() == 0
    alone = filter_interactions(docs, labels.limit(0))
    assert alone.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0 and alone.count() == got.count()


def test_filter_audit_sql(spark, rows):
    every = _audit_rows(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR); CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in every])
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", _labels())
    check(filter_interactions(spark.createDataFrame(every, DOCS), spark.createDataFrame(_labels(), "doc_id long, quality int, toxic int")), con, oracles.filter_audit())


def test_audit_of_other_filters(spark):
    docs = spark.createDataFrame([(k, "t") for k in range(8)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    cells = mask_cells(docs, labels, {"x": F.col("doc_id") < 4, "y": F.col("doc_id") % 2 == 0}, part=F.lit(None), copies=False)
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["shapley"]) for r in audit_filters(cells, "xy").collect()}
    assert got == {("xy", 1): (4, 4, 0, 2, 6), ("xy", 2): (2, 2, 2, 2, 6), ("yx", 1): (4, 4, 0, 2, 6), ("yx", 2): (2, 2, 2, 2, 6)}
    for bad in ("", "ABCDEFGH", "AA", ["ab"]):
        with pytest.raises(ValueError, match="filters"):
            audit_filters(cells, bad)


# conversation repair

TALK = "conv_id long, turn long, role string, text string"


def _order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16])


def _repair_brute(rows):
    """Plan and repaired lines of one conversation's rows (turn, role, text), from the end backwards."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=_order)
    seen, faults, marks = set(), Counter(), []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        mark = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
        seen.add((role, text))
        faults[mark] += 1
        marks.append(mark)
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {s: (0, "") if s in ("", "a") else None for s in allowed}  # behind the last row, before insertions
    far = (10**9, "")

    def insert(table):
        out = dict(table)
        for _ in range(3):
            for s in allowed:
                n = "a" if s == "u" else "u"
                if out[n] and (out[s] or far) > (x := (out[n][0] + 2, "I" + out[n][1])):
                    out[s] = x
        return out

    best = insert(best)
    for (_, role, _), mark in reversed(list(zip(rows, marks, strict=True))):
        new = {}
        for s in allowed:
            n, options = "a" if s == "u" else "u", []
            if best[s]:
                options.append((best[s][0] + 3, "D" + best[s][1]))
            if mark not in ("blank", "duplicate"):
                more = mark == "truncated"
                if best[n]:
                    options.append((best[n][0] + 2 + more, "R" + best[n][1]))
                i = role[:1]
                if i and i in allowed[s] and best[i]:
                    options.append((best[i][0] + more, "K" + best[i][1]))
            new[s] = min(options, default=None)
        best = insert(new)
    cost, audit = best[""]
    lines, at, state = [], 0, ""
    for e in audit:
        if e != "I":
            (_, role, text), at = rows[at], at + 1
        if e == "D":
            continue
        who = role if e == "K" else "assistant" if state == "u" else "user"
        lines.append((e, who, "" if e == "I" else text))
        state = who[:1]
    assert re.fullmatch("(s?(ua)+)?", "".join(w[:1] for _, w, _ in lines)) and at == len(rows)
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit), lines


def _talks(n, seed, length):
    rng = random.Random(seed)
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "", "tool", "ustad", None, "assistant"]
    texts = ["Hi.", "So?", "Well", "A long one!", "", " \n\t", None, "x. ", "é…", "Yes! ", "...", "ok"]
    out = []
    for c in range(n):
        for k in range(length(rng)):
            role = ("user", "assistant")[k % 2] if rng.random() < 0.7 else rng.choice(roles)
            text = rng.choice(texts) if rng.random() < 0.5 else f"Sentence {rng.randrange(10**6)}{rng.choice('. .!?')}"
            out.append((c, rng.choice((k, k, k, k + 1, None)), role, text))
    return out


def test_the_search_against_all_edits():
    """Every sequence of edits of short conversations, two insertions in a row included."""
    rng = random.Random(9)
    for _ in range(150):
        code = "".join(rng.choice("xsuauaua-SUA_") for _ in range(rng.randrange(5)))
        found = []
        for kinds in itertools.product("DKR", repeat=len(code)):
            for before in itertools.product(range(3), repeat=len(code) + 1):
                cost, state, edits = 0, 0, ""
                for k in range(len(code) + 1):
                    for _ in range(before[k]):
                        cost, state, edits = cost + 2, cr._NEXT[state][1], edits + "I"
                    if k == len(code):
                        break
                    row, e = code[k], kinds[k]
                    edits += e
                    if e == "D":
                        cost += 3
                        continue
                    cost += (2 if e == "R" else 0) + (row in "SUA_")
                    state = None if row == "x" else cr._NEXT[state][1] if e == "R" else cr._KEPT.get((state, cr._PLAIN.get(row, row)))
                    if state is None:
                        break
                else:
                    continue
                if state in cr._ACCEPTING:
                    found.append((cost, edits))
        assert cr._search(code, 0, True) == {s: v for s, v in cr._search(code, 0, True).items() if v == min(found)} != {}, code


@pytest.mark.parametrize("length", [lambda r: r.randrange(9), lambda r: r.choice((cr.STRETCH - 1, cr.STRETCH, cr.STRETCH + 1, 4 * cr.STRETCH + 7))])
def test_conversation_repair(spark, length):
    rows = _talks(60 if length(random.Random(1)) < 9 else 12, 5, length)
    rows += [(None, 0, "user", "Who?"), (None, 1, "assistant", "Me."), (77, None, None, None), (78, 2**62, "user", "far " * 50_000 + "."), (78, 5, "user", "near.")] + [(79, 1, "user", "Same.")] * 5
    df = spark.createDataFrame(rows, TALK).withColumns({c: F.lit("x") for c in ("plan", "audit", "present", "digest", "initial", "edit", "at")}).repartition(3)
    want = {c: _repair_brute([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    got = repair_conversations(df).collect()
    assert len(got) == len(want)
    for r in got:
        plan, lines = want[r["conv_id"]]
        assert tuple(r)[1:8] == plan, r
        assert r["repaired_sha256"] == sha("\n".join(f"{who}:{text}" for _, who, text in lines))
    assert {r["conv_id"]: tuple(r)[1:] for r in plan_repairs(df).collect()} == {c: p for c, (p, _) in want.items()}
    out = {}
    for r in repaired_rows(df).collect():
        out.setdefault(r["conv_id"], []).append((r["at"], r["edit"], r["role"], r["text"]))
    assert {c: [x[1:] for x in sorted(v)] for c, v in out.items()} == {c: lines for c, (_, lines) in want.items() if lines}


def test_conversation_repair_of_nothing(spark):
    none = spark.createDataFrame([], TALK)
    assert repair_conversations(none).count() == 0 and repaired_rows(none).count() == 0
    gone = spark.createDataFrame([(1, 0, "user", "x"), (1, 1, "user", "y"), (2, 0, "user", "Z.")], TALK)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_conversations(gone, F.col("conv_id") != 1).collect()}
    assert got == {1: (0, 0, 0, 0, 0, 0, "", sha("")), 2: (0, 0, 0, 0, 0, 2, "KI", sha("user:Z.\nassistant:"))}


def test_conversation_repair_sql(spark):
    rows = [r for r in _talks(80, 21, lambda r: r.randrange(1, 12)) if r[2] != ""] + [(None, 3, "user", "null id"), (500, None, "user", None)]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    df = spark.createDataFrame(rows, TALK)
    check(repair_conversations(damaged(df), F.col("present")), con, oracles.conversation_repair())
    acts = Counter(zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 for c, t, *_ in rows)
    assert set(range(5)) <= set(acts) and damaged(df).where("not present").count() == acts[0] and damaged(df).count() == len(rows) + acts[3]


# pieces


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))


ODD = ["a", "the", " ", "  ", "\n", "\t", "\r", "\r\n", "▁", "é", "日本", "😀", ".", ",", "0", "<s>", "</s>", "<unk>", "<0x0A>", "x" * 70, "\0", "//", "});", " ", "ﬁ", " " * 17, "  \n  ", "﻿", "é"]


def test_chunks_are_independent(library):
    import pyarrow as pa

    rng = random.Random(1)
    pieces = Pieces(tokenizer_file("piece_bpe_32k.model"))
    texts = ["", *ODD, *("".join(rng.choice(ODD) for _ in range(rng.randint(1, 30))) for _ in range(3000))]
    assert pieces.cuts
    chunks, ends = pieces.cut(pa.array(texts))
    for k, text in enumerate(texts):
        own = chunks[ends[k] : ends[k + 1]].to_pylist()
        assert own == pieces.chunks(text)
        assert [i for ids in pieces.encode(own) for i in ids] == library.encode(text), text


@pytest.mark.parametrize("table_bytes", [0, 300, 64 << 20])
def test_piece_encoding(spark, docs, nothing, rows, library, table_bytes):
    path = tokenizer_file("piece_bpe_32k.model")
    rng = random.Random(2)
    more = [(3000 + k, " ".join(rng.choice(ODD) for _ in range(40))) for k in range(60)]
    every = docs.select("*").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    got = encode_pieces(every, path, with_text=True, table_bytes=table_bytes)
    assert got.columns == ["doc_id", "ids", "decoded"]
    ids = lambda t: library.encode(t or "")
    want = Counter((i, tuple(ids(t)), library.decode(ids(t)) if t else "") for i, t, *_ in [*rows, *more])
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in got.collect()) == want
    assert Counter(map(tuple, decode_pieces(got, path).collect())) == Counter((i, t) for i, _, t in want.elements())
    assert encode_pieces(nothing, path, table_bytes=table_bytes).count() == 0


def test_pieces_of_other_files_are_encoded_whole(docs, rows, library, monkeypatch):
    class Whole(Pieces):
        def __init__(self, path):
            super().__init__(path)
            self.cuts = False

    monkeypatch.setattr(piece_encoding, "Pieces", Whole)
    got = encode_pieces(docs, tokenizer_file("piece_bpe_32k.model"))
    assert got.columns == ["doc_id", "ids"]
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in got.collect()) == Counter((i, tuple(library.encode(t or ""))) for i, t, *_ in rows)


def test_decoding_of_any_ids(spark, library):
    ids = [[], None, [1, 2], [259, 259, 5], [300, 14, 227, 130], [31999, 0, 278]]
    got = decode_pieces(spark.createDataFrame(list(enumerate(ids)), "doc_id int, ids array<int>"), tokenizer_file("piece_bpe_32k.model"))
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {k: library.decode(x) if x else "" for k, x in enumerate(ids)}
