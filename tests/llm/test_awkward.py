"""Cases that once went wrong: repeated and null ids, few labels, many languages, odd weights, unbroken text, quotes and case."""

import random
import time
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rimecast.llm import pii
from rimecast.llm.decontaminate import drop_contaminated, find_contamination
from rimecast.llm.language_id import accept, identify
from rimecast.llm.line_dedup import remove_boilerplate
from rimecast.llm.mixing import mix_sources, whole_weights
from rimecast.llm.near_dups import deduplicate
from rimecast.llm.toxicity import score_toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], DOCS)


def _near(a, b, k=5, percent=80):
    sets = []
    for t in (a, b):
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return bool(sets[0]) and bool(sets[1]) and 100 * len(sets[0] & sets[1]) >= percent * len(sets[0] | sets[1])


def test_one_row_of_each_group_stays(spark):
    """Near-equal texts under one id, under null ids, and both; one id in two groups; texts without a word."""
    rng = random.Random(4)
    base = [[f"w{rng.randrange(10**6)}" for _ in range(60)] for _ in range(6)]
    change = lambda b, n: " ".join([*b[:-1], f"x{n}"])
    rows = [(1, change(base[0], 0)), (1, change(base[0], 1)), (1, change(base[0], 2)), (None, change(base[1], 0)), (None, change(base[1], 1)), (None, change(base[2], 0)), (7, change(base[2], 1)), (5, change(base[3], 0)), (5, change(base[4], 0)), (6, change(base[4], 1))]
    rows += [(4, change(base[5], 0))] * 3 + [(4, change(base[5], 1)), (3, change(base[5], 2)), (8, None), (8, None), (None, ""), (None, ""), (9, " "), (9, "\n")]
    got = Counter((r["doc_id"], r["text"]) for r in deduplicate(_docs(spark, [(i, t, "en", "s") for i, t in rows]).repartition(4)).collect())
    groups, left = [], list(dict.fromkeys(rows))
    while left:
        group = [left.pop()]
        for x in group:
            for y in [y for y in left if _near(x[1], y[1])]:
                left.remove(y)
                group.append(y)
        groups.append(group)
    stay = Counter()
    for group in groups:
        least = min((i is None, i or 0) for i, _ in group)
        found = [x for x in got if x in group]
        assert len(found) == 1 and ((found[0][0] is None), found[0][0] or 0) == least, group
        stay[found[0]] += 1
    assert got == stay


def test_a_line_has_one_home(spark):
    """A line that only documents without an id have stays in one of them; with ids, in the smallest."""
    rows = [(None, f"own text {k}\nonly without ids", "en", f"s{k}") for k in range(14)]
    rows += [(i, f"other text {k}\non both", "en", f"s{k}") for k, i in enumerate([None] * 6 + [30, 20, 10] + [None] * 5)]
    rows += [(10, "other text 8\non both", "en", "s8")]
    got = [(r["doc_id"], r["text"], r["n_removed"]) for r in remove_boilerplate(_docs(spark, rows)).collect()]
    assert len(got) == len(rows)
    assert sum("only without ids" in t for _, t, _ in got) == 1
    assert [(i, t) for i, t, _ in got if "on both" in t] == [(10, "other text 8\non both")] * 2
    assert sum(n for *_, n in got) == 13 + 13


def _shares(weights, cap):
    """Water filling with exact numbers."""
    total, out, open_ = cap.pop("total"), dict.fromkeys(cap, Fraction(0)), {k for k in cap if weights.get(k, 1)}
    while open_:
        left, w = total - sum(out[k] for k in cap if k not in open_), sum(Fraction(str(weights.get(k, 1))) for k in open_)
        full = {k for k in open_ if cap[k] * w <= Fraction(str(weights.get(k, 1))) * left}
        if not full:
            for k in open_:
                out[k] = Fraction(str(weights.get(k, 1))) * left / w
            break
        for k in full:
            out[k] = Fraction(cap[k])
        open_ -= full
    return out


@pytest.mark.parametrize("weights", [{"a": 0.6, "b": 0.4, "c": 0}, {"a": Fraction(1, 3), "b": "2/3", "c": 1}, {"a": 0}, {"a": 0, "b": 0, "c": 0}, {"a": 1e-3, "b": 5}])
def test_weights_are_exact(spark, weights):
    rng = random.Random(8)
    rows = [(k, "w " * rng.randint(1, 9), "en", "abc"[k % 3]) for k in range(600)]
    docs = _docs(spark, rows).withColumn("topic", F.when(F.col("source") == "c", None).otherwise(F.col("source")))
    weights = {("" if k == "c" else k): v for k, v in weights.items()}
    out = mix_sources(docs, weights={"domain": weights}, share=(1, 2), max_epochs=2, domain=F.col("topic")).groupBy("domain").agg(F.sum("n_tokens")).collect()
    tokens = Counter()
    for _, t, _, s in rows:
        tokens["" if s == "c" else s] += len(t.split())
    cap = {k: 2 * n for k, n in tokens.items() if Fraction(str(weights.get(k, 1)))}
    want = _shares(weights, cap | {"total": min(sum(tokens.values()) // 2, sum(cap.values()))})
    got = {r[0]: r[1] for r in out}
    assert set(got) == {k for k, v in want.items() if v > 9}
    assert all(0 <= want[k] - got[k] <= 10 for k in got)


def test_weights_are_checked():
    assert whole_weights({"a": 0.6, "b": "1/4", "c": 2}) == ({"a": 12, "b": 5, "c": 40}, 20)
    with pytest.raises(ValueError, match="negative: b"):
        whole_weights({"a": 1, "b": -0.5})


def test_few_labels_are_enough(spark):
    rng = random.Random(6)
    words = [a + b for a in "th en re on at in er ed ou le".split() for b in "a is or um ex ol an it ea ub".split()]
    rows = [(i, " ".join(rng.choice(words) for _ in range(30)) + (" grubbish snarlwort" if i % 20 == 0 else ""), "en", "s") for i in range(280)]
    labels = spark.createDataFrame([(i, int(i % 20 == 0)) for i in range(140)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in score_toxicity(_docs(spark, rows), labels, learn=F.lit(True)).collect()}
    assert min(got[i] for i in got if i % 20 == 0) > max(got[i] for i in got if i % 20)
    assert all((got[i] >= 0.3) == (i % 20 == 0) for i in range(140, 280))


def _languages(n, per, seed=3):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        own = random.Random(k)
        parts = ["".join(own.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(own.randint(2, 4))) for _ in range(25)]
        out += [(f"{chr(97 + k // 26)}{chr(97 + k % 26)}x", " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(20))) for _ in range(per)]
    return out


def test_many_languages(spark):
    """No number of languages is too many: each is learned, whatever the others."""
    rows = [(k, text, lang, "s") for k, (lang, text) in enumerate(_languages(72, 8))]
    got = {r["doc_id"]: r["lang_pred"] for r in identify(_docs(spark, rows), learn=F.col("doc_id") % 4 != 0).collect()}
    held = [(i, lang) for i, _, lang, _ in rows if i % 4 == 0]
    assert len({got[i] for i, _ in held}) == 72 and sum(got[i] == lang for i, lang in held) >= 0.9 * len(held)


def test_repeated_rows_of_a_language(spark):
    some = _languages(2, 40)
    rows = [(k, text, "enx" if lang == "aax" else "frx", "s") for k, (lang, text) in enumerate(some) if lang == "aax" or k < 43]
    last = rows[-3:]
    docs = _docs(spark, rows).unionByName(_docs(spark, last).crossJoin(spark.range(3000)).drop("id"))
    got = identify(docs, learn=F.lit(True)).groupBy("doc_id", "lang_pred").count().collect()
    assert {r["doc_id"]: r["lang_pred"] for r in got} == {i: lang for i, _, lang, _ in rows}
    assert accept(docs, learn=F.lit(True)).where("lang = 'frx'").count() >= 3001


def _brute_language(docs, learn, text):
    """Family first, then one against one, trained here by plain gradient steps on the same features."""
    from rimecast.llm import language_id as li
    from rimecast.llm.arrays import text_buffers
    import pyarrow as pa

    x = lambda ts: li.features(*text_buffers(pa.array(ts))).astype(np.float64)
    rows = [(lang, t) for i, t, lang, _ in docs if learn(i)]
    feats, langs = x([t for _, t in rows]), np.array([v for v, _ in rows])

    def fit(use, y):
        w, xs = np.zeros(feats.shape[1] + 1), np.c_[feats[use], np.ones(use.sum())]
        share = np.where(y > 0, 0.5 / (y > 0).sum(), 0.5 / (y < 0).sum()) * len(y)
        for _ in range(3000):
            gap = np.maximum(0, 1 - y * (xs @ w))
            g = xs.T @ (-2 * 20.0 * share * y * gap)
            g[:-1] += w[:-1]
            w -= 2e-4 * g
        return w

    def duel(names, label, v):
        wins = Counter({n: 0 for n in names})
        for a in range(len(names)):
            for b in range(a + 1, len(names)):
                use = (label == names[a]) | (label == names[b])
                m = float(np.r_[v, 1] @ fit(use, np.where(label[use] == names[a], 1.0, -1.0)))
                wins[names[a] if m > 0 else names[b]] += 1
        return wins.most_common(1)[0][0] if names else None

    family = np.array([li._FAMILY.get(v, v) for v in langs])
    out = []
    for v in x(text):
        f = duel(sorted(set(family)), family, v)
        out.append(duel(sorted(set(langs[family == f])), np.where(family == f, langs, ""), v))
    return out


def test_languages_against_brute_force(spark):
    names = dict(zip(sorted({v for v, _ in _languages(4, 1)}), ("en", "de", "fr", "es"), strict=True))
    docs = [(k, text, names[lang], "s") for k, (lang, text) in enumerate(_languages(4, 12))]
    got = {r["doc_id"]: r["lang_pred"] for r in identify(_docs(spark, docs), learn=F.col("doc_id") % 3 != 0).collect()}
    held = [d for d in docs if d[0] % 3 == 0][:8]
    assert [got[i] for i, *_ in held] == _brute_language(docs, lambda i: i % 3 != 0, [t for _, t, *_ in held])


@pytest.mark.parametrize("unit", ["keya", "token=", "secret:\"", "password is ", "a@b.", "key'", "1.", "+1 "])
def test_personal_data_of_unbroken_text_in_linear_time(unit):
    model = pii.train()
    took = []
    for size in (1 << 17, 1 << 20):
        text = unit * (size // len(unit))
        begun = time.perf_counter()
        spans = pii.all_spans(text, pii.base_spans(text), model)
        took.append(time.perf_counter() - begun)
        assert all(0 <= s < e <= len(text) for s, _, e in spans)
    assert took[1] < 60 and took[1] < 24 * max(took[0], 0.05)


def test_marked_values_end_where_they_did():
    """The end of a run is looked up once; results are those of looking each time."""
    import re

    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["key", "=", "token", ": ", " ", '"', "'", "abc", "def123", ".", ")", "password", " is ", "\n", "é", "login"]) for _ in range(rng.randint(1, 25)))
        want, at = [], 0
        plain = re.compile(pii._MARKED.pattern.replace(r"(?=([^\s\"'])[^\s]{3})", r"([^\s\"'][^\s]{3,})"), re.IGNORECASE | re.ASCII)
        while m := plain.search(text, at):
            start, end = m.span(m.lastindex)
            if m.lastindex == 3:
                end = start + len(text[start:end].rstrip(".,;:)]}>\"'"))
            if end - start >= 4 and not pii._NAMED.match(text, start):
                want.append((start, end))
            at = start
        assert list(pii._marked(text)) == want, text


def test_quotes_and_case_dont_hide_an_item(spark):
    item = "What did the émigré say to “Éloïse” about the old lighthouse keeper? He said that the «lamp» hadn’t been lit since the great storm of the year."
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    texts = [item, item.lower(), item.upper(), item.replace("“", '"').replace("”", '"').replace("«", "<<").replace("»", "'").replace("’", "'"), "before it " + item.replace("É", "é") + " behind it", "What did the other one say to someone about the new harbour? He said nothing at all to anybody there."]
    docs = _docs(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])
    got = {r["doc_id"]: r["contaminated"] for r in find_contamination(docs, items).collect()}
    assert got == {0: True, 1: True, 2: True, 3: True, 4: True, 5: False}
    assert [r["doc_id"] for r in drop_contaminated(docs, items).collect()] == [5]


def _brute_contamination(docs, items, overlap=0.8):
    """Shingles of words by the letters, marks and digits of each character."""
    import unicodedata

    from rimecast.llm.decontaminate import question_and_answer

    def words(t):
        return "".join(c if unicodedata.category(c)[0] in "LMN" else " " for c in t.lower()).split()

    def grams(w, n):
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}

    out = defaultdict(set)
    for i, text in docs:
        have = words(text or "")
        for item, t in items:
            q, a = question_and_answer(t)
            whole = words(t)
            roles = [whole, whole] if q == t or len(whole) < 5 or not words(q) or not words(a) else [words(q), words(a)]
            share = []
            for r in roles:
                n = min(5, max(1, len(r)))
                want = grams(r, n)
                share.append(len(want & grams(have, n)) / len(want) if want else 0)
            if whole and min(share) >= overlap - 1e-9:
                out[i].add(item)
    return out


def test_contamination_against_brute_force(spark):
    rng = random.Random(12)
    vocabulary = ["Straße", "élan", "Ångström", "naïve", "can’t", "«mot»", "数学", "x²", "Ω", "don't", "“well”", "under_score", "a", "of", "3.14", "नमस्ते", "Ÿ"] + [f"w{k}" for k in range(40)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.randint(1, 14)) + rng.choice(["? ", ". ", "\nAnswer: ", " "]) + say(rng.randint(1, 9))) for k in range(30)]
    docs = [(k, say(20) + " " + rng.choice([str.lower, str.upper, str])(items[k % 30][1]).replace("’", rng.choice("’'")).replace("“", '"') + " " + say(9)) for k in range(90)] + [(100, None), (101, "")]
    got = find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = _brute_contamination(docs, items)
    assert {r["doc_id"]: set(r["items"]) for r in got} == {i: want[i] for i, _ in docs}


def test_sizes_of_batches(spark):
    from rimecast.llm import common

    assert [common._bytes(x) for x in ("67108864", "67108864b", "65536k", "64m", "64MB", " 1g ", "-1")] == [64 << 20] * 5 + [1 << 30, 1 << 62]
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    for size, after in (("64m", f"{8 << 20}b"), ("4MB", "4MB")):
        spark.conf.set(key, size)
        common.settings(spark)
        assert spark.conf.get(key) == after
    spark.conf.set(key, before)


def test_a_failed_block_leaves_no_tables(spark):
    from rimecast.llm import common

    before = list(common._written(spark))
    with pytest.raises(RuntimeError, match="half way"), common.only_last(spark):
        one = common.materialize(spark.range(3), "one")
        common.materialize(spark.range(4), "two")
        raise RuntimeError("half way")
    assert common._written(spark) == before
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FileNotFound"):
        spark.read.parquet(one.inputFiles()[0]).count() if one.inputFiles() else one.count()
    with common.only_last(spark):
        common.materialize(spark.range(3), "one")
        two = common.materialize(spark.range(4), "two")
    assert len(common._written(spark)) == len(before) + 1 and two.count() == 4
