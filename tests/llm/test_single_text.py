"""Operators that look at one text at a time: counts, rules, languages, classifiers, the language model."""

from __future__ import annotations

import collections
import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerloom.llm import language_id, lm_scoring, quality_classifier, quality_rules, registry, token_counts, toxicity
from ledgerloom.llm.docstats import Stats
from ledgerloom.llm.textcodes import chunks

from .conftest import NASTY, words

SF = "/root/testdata/sf0.01"
BPE = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- token counts


def test_prefix_tables_are_those_of_the_library():
    lib, own = Tokenizer.from_file(BPE), token_counts.Vocabulary(BPE)
    rng = random.Random(1)
    letters = list("abct 'slre \n\t.!,12éü<|>🙂  ")
    texts = ["", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endof", "we'll 're they've 'x", "a  \n\n b 　 c\x1c\x85d",
             "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "日本語テキスト 🙂🙂"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    for t in texts:
        table = own.table(t)
        want = [len(lib.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)]
        assert table.tolist() == want, t


def test_a_cut_is_the_longest_prefix_within_the_budget():
    own = token_counts.Vocabulary(BPE)
    table = own.table(words(3, 60))
    k = token_counts.cut(table, 40)
    assert table[k] <= 40 and (table[k + 1:] > 40).all()
    assert token_counts.cut(own.table(""), 0) == 0


def test_token_counts_of_nasty_rows(nasty, no_docs):
    lib = Tokenizer.from_file(BPE)
    rows = token_counts.count_tokens(nasty, BPE, with_table=True).collect()
    got = sorted(((r.doc_id or -1), r.n_bytes, r.n_tokens, r.over_limit) for r in rows)
    n = [len(lib.encode(t or "", add_special_tokens=False).ids) for _, t, _, _ in NASTY]
    assert got == sorted(((i or -1), len((t or "").encode()), k, k > 1024) for (i, t, _, _), k in zip(NASTY, n))
    assert all(r.prefix_tokens[-1] == r.n_tokens and r.prefix_tokens[r.fit_chars] <= 1024 for r in rows)
    assert token_counts.count_tokens(no_docs, BPE).collect() == []


# ---------------------------------------------------------------- quality rules


def brute_counts(text: str | None) -> tuple:
    t = text or ""
    w = t.encode().split()
    grams = collections.Counter(tuple(w[k:k + 3]) for k in range(len(w) - 2))
    covered = {j for k in range(len(w) - 2) if grams[tuple(w[k:k + 3])] > 1 for j in (k, k + 1, k + 2)}
    filled = [x for x in t.split("\n") if x.encode().split()]
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in t), len(filled) - len(set(filled)), len(covered))


def test_counts_and_verdict_of_nasty_rows(nasty, no_docs):
    extra = quality_rules.quality_rules(nasty).collect()
    got = sorted(((r.doc_id or -1), *(r[c] for c in quality_rules.COUNTS), r.base_failed) for r in extra)
    want = []
    for i, t, _, _ in NASTY:
        c = brute_counts(t)
        want.append(((i or -1), *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(want)
    assert not any(r.kept and r.base_failed for r in extra)
    assert quality_rules.quality_rules(no_docs).collect() == []


def test_rules_agree_with_sql_on_nasty_rows(nasty):
    con = duckdb.connect()
    con.register("documents", nasty.select("doc_id", "text").toPandas().astype({"doc_id": "Int64"}))
    columns = ["doc_id", *quality_rules.COUNTS, "base_failed", "kept"]
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({quality_rules.SQL})").fetchall()
    got = [tuple(r[c] for c in columns) for r in quality_rules.quality_rules(nasty).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_the_order_of_the_rules_changes_no_verdict(nasty):
    rows = [words(k, 30 + k) + ("\n### x" * k) for k in range(40)] + ["A " * 80, "the " * 90, "ABC! " * 70]
    for c in chunks(pa.array(rows)):
        rng = random.Random(4)
        first = quality_rules.cascade(c, quality_rules.RULES)[0] >= 0
        for _ in range(5):
            order = list(quality_rules.RULES)
            rng.shuffle(order)
            assert ((quality_rules.cascade(c, tuple(order))[0] >= 0) == first).all()


def test_short_circuit_skips_rejected_documents():
    rows = ["short"] * 30 + [words(k, 80) for k in range(10)]
    for c in chunks(pa.array(rows)):
        _, seen, owners = quality_rules.cascade(c, quality_rules.RULES)
        assert len(owners[-1]) == 10 and seen[-1].chunk.n == 10


# ---------------------------------------------------------------- language identification


def test_probabilities_of_every_context_add_up_to_one():
    texts = {"aa": "abab abba baab", "bb": "xyxy yxxy é"}
    grams = []
    for lang, t in texts.items():
        for c in chunks(pa.array([t, t[:5]])):
            s = c.data.astype(np.int64) + 2
            g = np.zeros(len(s), np.int64)
            for k in reversed(language_id._contexts(c, s)):
                g = g * 512 + k
            found, n = np.unique(g * 512 + s, return_counts=True)
            grams += [(lang, int(a), int(b)) for a, b in zip(found, n)]
    names, gram, n = zip(*grams)
    trees = language_id.build_trees(list(names), np.array(gram), np.array(n))
    p = np.exp2(-trees.bits.astype(float))
    weight = np.ones(trees.bits.shape[1])
    weight[0], weight[1] = 0, 256 - (trees.bits.shape[1] - 2)
    assert np.allclose((p * weight[None, :, None]).sum(1), 1, atol=1e-5)


def brute_ppm(train: list[bytes], text: bytes, order: int = language_id.ORDER) -> float:
    count = collections.defaultdict(collections.Counter)
    for t in train:
        symbols = [-1] * order + list(t)
        for i in range(order, len(symbols)):
            for k in range(order + 1):
                count[tuple(symbols[i - k:i])][symbols[i]] += 1

    def p(context: tuple, s: int) -> float:
        below = (lambda x: p(context[1:], x)) if context else (lambda x: 1 / 256)
        seen = count.get(context)
        if not seen:
            return below(s)
        total = sum(seen.values()) + len(seen)
        if s in seen:
            return seen[s] / total
        left = 1 - sum(below(x) for x in seen)
        return len(seen) / total * below(s) / left

    symbols = [-1] * order + list(text)
    return -sum(math.log2(p(tuple(symbols[i - order:i]), symbols[i])) for i in range(order, len(symbols)))


def test_code_lengths_are_those_of_a_plain_context_tree(llm):
    train = {"aa": ["abab abba baab", "aab"], "bb": ["xyxy yxxy é", "y"]}
    docs = llm.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate((a, b) for a in train for b in train[a])],
                               "doc_id long, text string, lang string")
    trees = language_id.train(docs, F.lit(True))
    tests = ["abab", "yxé", "zz ab", "", "ba\nxy", "ü"]
    got = np.concatenate([trees.code_lengths(c) for c in chunks(pa.array(tests))])
    want = [[brute_ppm([x.encode() for x in train[a]], t.encode()) for a in ("aa", "bb")] for t in tests]
    assert np.allclose(got, want, rtol=1e-5, atol=1e-4)


def test_languages_of_held_out_documents(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    found = registry.queries()["op9_language_id"](llm, SF).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = found[found.held_out]
    assert len(found) == docs.count() and (held.lang == held.lang_pred).mean() > 0.99
    assert found.score.between(0, 1).all()


def test_language_of_nasty_rows(nasty, no_docs):
    rows = language_id.language_id(nasty).collect()
    assert len(rows) == len(NASTY)
    learned = {lang for i, t, lang, _ in NASTY if lang and t is not None}
    for r in rows:
        texts = [t for i, t, _, _ in NASTY if i == r.doc_id]
        if all(t is None or not any(ch.isalpha() for ch in t) for t in texts):
            assert r.lang_pred == "und" and r.score == 0
        elif r.doc_id is not None:
            assert r.lang_pred in learned and 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 3 == 1)
    assert language_id.language_id(no_docs).collect() == []
    kept = language_id.keep_identified(nasty, language_id.train(nasty, F.lit(True)))
    assert kept.columns == nasty.columns and {r.doc_id for r in kept.collect()} >= {1, 6, 7, 9}
    assert not {2, 3, 4, 11} & {r.doc_id for r in kept.collect()}


# ---------------------------------------------------------------- classifiers


@pytest.mark.parametrize("name, label", [("op3_toxicity", "toxic"), ("op4_quality_classifier", "quality")])
def test_classifier_on_held_out_labels(llm, name, label):
    sf = SF if label == "quality" else "/root/testdata/sf0.1"
    found = registry.queries()[name](llm, sf).join(llm.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").toPandas()
    assert len(found) == llm.read.parquet(f"{sf}/documents.parquet").count() and found.score.between(0, 1).all()
    held = found[found.held_out & found[label].notna()]
    order = held.score.rank()
    ones = held[label] == 1
    auc = (order[ones].mean() - (ones.sum() + 1) / 2) / (~ones).sum()
    assert auc > 0.95
    assert (found.predicted == (found.score >= (0.7 if label == "toxic" else 0.3))).all()


@pytest.mark.parametrize("operator", [toxicity.toxicity, quality_classifier.quality])
def test_classifiers_on_nasty_rows(operator, nasty, no_docs, labels, no_labels):
    for given in (labels, no_labels):
        rows = operator(nasty, given).collect()
        assert len(rows) == len(NASTY) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        same = collections.defaultdict(set)
        for r in rows:
            same[r.doc_id].add(r.score)
        assert len(same[1]) == 1
    assert operator(no_docs, labels).collect() == []


def test_an_unseen_misspelling_is_toxic():
    rng = random.Random(2)
    texts, label = [], []
    for k in range(400):
        w = words(k, 40).split()
        if k % 2:
            w.insert(rng.randrange(40), rng.choice(["wretchedfool", "vilescoundrel"]))
        texts.append(" ".join(w))
        label.append(k % 2)
    model = toxicity.fit(texts, np.array(label), 0.5)
    tests = [words(900, 40) + " wretchedfol " + words(901, 20), words(902, 60)]
    score = np.concatenate([model.score(c) for c in chunks(pa.array(tests))])
    assert score[0] > 0.7 > 0.3 > score[1]


def test_isotonic_fit_is_monotone_and_keeps_the_mean():
    rng = np.random.default_rng(0)
    w, m = rng.integers(1, 9, 50).astype(float), rng.random(50)
    fit = quality_classifier.isotonic(w, m)
    assert (np.diff(fit) >= -1e-12).all() and np.isclose((w * fit).sum(), (w * m).sum())


def test_ratios_ignore_other_documents():
    rows = [words(k, 20) for k in range(5)] + ["", "x"]
    whole = np.concatenate([quality_classifier.ratios(c) for c in chunks(pa.array(rows))])
    alone = np.concatenate([quality_classifier.ratios(c) for t in rows for c in chunks(pa.array([t]))])
    assert np.allclose(whole, alone)
    assert Stats(next(chunks(pa.array([""])))).get("n_repeat_words").tolist() == [0]


# ---------------------------------------------------------------- the language model


def brute_base(rows: list[tuple]) -> tuple[int, list[tuple]]:
    count: collections.Counter = collections.Counter()
    for i, t in rows:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 10:
            count.update((t or "").encode().lower().split())
            count["end"] += 1
    total, kinds = sum(count.values()), len(count)
    out = []
    for i, t in rows:
        tokens = [*(t or "").encode().lower().split(), "end"]
        base = sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
        out.append((i if i is not None else -1, len(tokens), sum(count[w] > 0 for w in tokens), round(base, 6)))
    return total, sorted(out)


@pytest.mark.parametrize("top", [1 << 19, 40])
def test_language_model_base_of_nasty_rows(nasty, no_docs, monkeypatch, top):
    monkeypatch.setattr(lm_scoring, "TOP_WORDS", top)
    rows = lm_scoring.lm_scores(nasty).collect()
    total, want = brute_base([(i, t) for i, t, _, _ in NASTY])
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows)
    assert got == want and {r.train_tokens for r in rows} == {total}
    assert all(r.score <= 0 and math.isfinite(r.score) for r in rows)
    assert lm_scoring.lm_scores(no_docs).collect() == []


def test_model_probabilities_add_up_to_one():
    share = np.full(lm_scoring.UNITS, 1 / lm_scoring.UNITS)
    rng = np.random.default_rng(1)
    vector = lm_scoring.start(share) + rng.normal(size=lm_scoring.Parameters.SIZE) * 0.3
    s1, s2, norm = lm_scoring.Parameters(vector).tables()
    for a, b in rng.integers(0, lm_scoring.UNITS, (20, 2)):
        assert np.isclose(np.exp(s1[a] + s2[b] - norm[a, b]).sum(), 1)


def test_model_beats_its_base_on_held_out_texts(llm):
    found = registry.queries()["op6_lm_scores"](llm, "/root/testdata/sf0.1").where("held_out").toPandas()
    assert found.score.sum() > found.base_score.sum()


# ---------------------------------------------------------------- rules, samples, many languages


def test_the_first_rule_that_rejects_is_named():
    """Against every rule run on every document; counts gathered on the way are those of whole chunks."""
    rng = random.Random(3)
    texts = [words(k, rng.choice([10, 60, 120])) + rng.choice(["", " ###" * 30, "\nsame line\nsame line" * 20, " SHOUT" * 90, " a b c" * 60]) for k in range(300)]
    (chunk,) = chunks(pa.array(texts + [None, "", "ten words " * 5], pa.large_string()))
    whole = quality_rules.Stats(chunk)
    flags = np.stack([r.rejects(*(whole.get(c) for c in r.needs)) for r in quality_rules.RULES])
    for order in (list(range(6)), [5, 3, 1, 0, 4, 2], [4, 2, 5, 0, 1, 3]):
        rules = tuple(quality_rules.RULES[i] for i in order)
        stopped, seen, owners = quality_rules.cascade(chunk, rules)
        first = np.where(flags[order].any(0), flags[order].argmax(0), -1)
        assert (stopped == first).all() and len(set(first.tolist())) > 4
        for stats, own in zip(seen, owners):
            for c in quality_rules.COUNTS:
                assert (stats.get(c) == whole.get(c)[own]).all()


def test_three_hundred_languages(llm):
    rows = [(k * 400 + j, f"{chr(97 + k % 10)}{chr(97 + k // 10 % 10)}{chr(97 + k // 100)} " * 6, f"lang{k:03d}") for k in range(300) for j in range(2)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = language_id.train(docs, F.lit(True))
    assert len(trees.languages) == 300
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, trees).collect()}
    assert np.mean([got[i] == lang for i, _, lang in rows]) > 0.95


def test_what_is_learnt_does_not_depend_on_the_files(llm):
    rows = [(k, words(k, 12), "ab"[k % 2]) for k in range(200)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string")
    one, two = (language_id.train(d, F.lit(True), train_docs=20) for d in (docs.coalesce(1), docs.repartition(7)))
    assert one.bits.shape == two.bits.shape and np.array_equal(one.bits, two.bits)
    assert not np.array_equal(one.bits.shape, language_id.train(docs, F.lit(True), train_docs=200).bits.shape)


def test_labels_without_a_document_take_no_place(llm, monkeypatch):
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, share: taken.append((texts, labels.tolist(), share)))
    docs = llm.createDataFrame([(k, f"text {k}") for k in range(500, 520)] + [(500, "another"), (501, None)], "doc_id long, text string")
    labels = llm.createDataFrame([(k, int(k % 2)) for k in range(520)], "doc_id long, toxic int")
    for layout in (docs.coalesce(1), docs.repartition(5)):
        toxicity.train(layout, labels, F.lit(True), train_docs=(4, 30))
    texts, classes, share = taken[0]
    assert sum(classes) == 4 and len(classes) == 14 and share == 0.5 and taken[0] == taken[1]
    assert "text 500" not in texts and "text 501" not in texts
