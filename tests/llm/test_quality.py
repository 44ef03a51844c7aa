"""Quality rules, the ranking classifier and toxicity."""

import random
import zlib

import numpy as np
import pytest

from airspark.llm import quality_rank, quality_rules, toxicity

WORDS = [a + b for a in ("ba", "lo", "mi", "ne", "ra", "su") for b in ("ta", "ko", "lim", "ne", "rus", "vi")]


def prose(r, n):
    return " ".join(r.choice(WORDS) + ("." if i % 9 == 8 else "") for i in range(n)) + f"\nend {r.random()}"


def plain_counts(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    marked = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_counts_match_their_definitions():
    r = random.Random(5)
    texts = ["", " \n\t", "a b c a b c", "x\nx\n x\n\nx", "#*$%&|<>", "é中 \xa0 \x1c a"]
    texts += [" ".join(r.choice("ab#") + r.choice(["", "\n", "\v"]) for _ in range(r.randint(0, 30))) for _ in range(300)]
    for t in texts:
        assert quality_rules.describe(t)[:5] == plain_counts(t), repr(t)


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, 0.5) for i, t in rows],
                                 "doc_id long, text string, lang string, kept int, posterior double")


def corpus(n=300):
    r = random.Random(6)
    rows = []
    for i in range(n):
        t = prose(r, 80)
        if i % 10 == 0:
            t = " ".join(w + r.choice(["###", "***", "&&&"]) for w in t.split())
        rows.append((i, t))
    return rows


def test_rules_verdicts(spark):
    rows = corpus() + [(None, None), (900, ""), (901, "short"), (902, "go " * 100), (5, corpus()[5][1])]
    got = quality_rules.judge(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    verdict = {r.doc_id: r.kept for r in got}
    assert all(verdict[i] == (i % 10 != 0) for i in range(300))
    assert not verdict[None] and not verdict[900] and not verdict[902]
    kept = quality_rules.keep_good(docs_frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "kept", "posterior"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, k in verdict.items() for _ in range(1 + (i == 5)) if k)
    assert quality_rules.judge(docs_frame(spark, []).limit(0)).count() == 0


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(20_000) < 0.85
    n = len(quality_rules.RULES)
    votes = np.ones((len(good), n), dtype=int)
    for j in range(n):
        votes[~good, j] = np.where(rng.random((~good).sum()) < 0.4, 0, 1)
    votes[rng.random(votes.shape) < 0.1] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.fit(patterns, counts.astype(float))
    assert abs(model.prior - 0.85) < 0.03
    assert np.abs(model.table[0, :, 0] - 0.4).max() < 0.06 and model.table[1, :, 0].max() <= 0.003
    told = model.log_odds(votes) > 0
    seen = (votes == 0).any(axis=1)
    assert (told == ~seen).mean() > 0.99


@pytest.mark.parametrize("share", [0.03, 0.1, 0.3])
def test_rule_tripped_by_clean_documents_loses_weight(share):
    """Bad documents trip two or three rules; a hot source of clean ones trips one."""
    rng = np.random.default_rng(0)
    n, rules = 20_000, len(quality_rules.RULES)
    bad = rng.random(n) < 0.08
    votes = np.ones((n, rules), dtype=int)
    for i in np.flatnonzero(bad):
        votes[i, rng.choice(rules, rng.integers(2, 4), replace=False)] = 0
    hot = ~bad & (rng.random(n) < share)
    votes[hot, 2] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_rules.fit(patterns, counts.astype(float))
    assert abs(model.table[1, 2, 0] - share) < 0.1 * share + 0.002
    assert model.weights()[2, 1] > model.weights()[0, 1] + 1  # a bad vote weighs less than another rule's
    kept = model.log_odds(votes) > 0
    assert kept[~bad].mean() > 0.99 and kept[bad].mean() < 0.01


def test_rule_that_only_fires_alone_still_rejects():
    votes = np.ones((10_000, len(quality_rules.RULES)), dtype=int)
    votes[:800, 0] = 0
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    kept = quality_rules.fit(patterns, counts.astype(float)).log_odds(votes) > 0
    assert not kept[:800].any() and kept[800:].all()


def test_posterior_row_by_row(spark):
    """Bayes' rule written out, over every row's votes, and the counts behind the overlapping rules."""
    rows = corpus() + [(900, ""), (901, "word " * 200_000), (902, " ".join(f"w{i}" for i in range(100_000)) + " ##" * 9000)]
    df = docs_frame(spark, rows)
    got = {r.doc_id: r for r in quality_rules.judge(df).collect()}
    model = quality_rules.learn(df.select(quality_rules.counts("text").alias("_c")))
    for i, text in rows:
        good, bad = model.prior, 1 - model.prior
        c = dict(zip(quality_rules.COUNTS, quality_rules.describe(text)))
        words = text.split()
        assert c["n_symbol_words"] == sum(any(s in w for s in "#*$%&|<>") for w in words)
        for k, (name, num, den, low, high) in enumerate(quality_rules.RULES):
            vote = -1 if not c[den] else 1 if c[num] / c[den] <= low else 0 if c[num] / c[den] >= high else -1
            assert got[i][f"vote_{name}"] == vote
            if vote >= 0:
                good, bad = good * model.table[1, k, vote], bad * model.table[0, k, vote]
        assert got[i].posterior == pytest.approx(good / (good + bad), rel=1e-9, abs=1e-12)
        assert got[i].kept == (not got[i].base_failed and got[i].posterior >= 0.5)


def test_one_bad_vote_among_good_ones_does_not_decide(spark):
    """Bad documents trip the overlapping rules; clean ones with a repeated line trip one."""
    r = random.Random(11)
    rows = corpus(600)
    echo = "so it goes on and on " * 3
    rows += [(1000 + i, prose(r, 70) + "\n" + echo + "\n" + echo) for i in range(12)]
    got = {x.doc_id: x for x in quality_rules.judge(docs_frame(spark, rows)).collect()}
    tripped = [x for x in got.values() if x.doc_id >= 1000 and x.vote_repeats == 0]
    assert tripped and all(x.kept for x in tripped)
    assert not any(got[i].kept for i in range(0, 600, 10)) and all(got[i].kept for i in range(600) if i % 10)


def test_rank_model_is_the_optimum_of_its_loss():
    rng = np.random.default_rng(2)
    y = (rng.random(300) < 0.7).astype(float)
    x = rng.normal(size=(300, len(quality_rank.FEATURES))) * rng.uniform(0.001, 2, len(quality_rank.FEATURES))
    x[:, 2] += y
    model = quality_rank.fit(x, y, np.arange(300))
    a, b = quality_rank.pairs(np.flatnonzero(y == 1), np.flatnonzero(y == 0))
    scale = np.maximum(x.std(axis=0), quality_rank.LEAST_SCALE)
    diff = (x[a] - x[b]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(20_000):  # plain gradient descent on the Bradley-Terry loss
        w += 0.5 * (diff.T @ (1 / (1 + np.exp(diff @ w))) / len(diff) - quality_rank.RIDGE * w)
    assert model.weights * scale == pytest.approx(w, abs=1e-4)
    wild = x[0].copy()
    wild[5] = 1e9  # no feature counts beyond what was learned
    assert model.probability(wild) == model.probability(np.where(np.arange(len(wild)) == 5, x[:, 5].max(), wild))


def test_rank_model_fits_differences_and_quantile():
    rng = np.random.default_rng(1)
    n = 1500
    y = (rng.random(n) < 0.8).astype(float)
    x = rng.normal(size=(n, len(quality_rank.FEATURES)))
    x[:, 2] += 4 * y
    model = quality_rank.fit(x, y, np.arange(n))
    scores = x @ model.weights
    share = (scores >= model.threshold).mean()
    assert abs(share - y.mean()) < 0.01  # the threshold is the quantile at the share of bad labels
    assert ((scores >= model.threshold) == (y == 1)).mean() > 0.95
    p = [model.probability(f) for f in x[:50]]
    assert all((a >= quality_rank.CUT) == (s >= model.threshold) for a, s in zip(p, scores))
    for only in (np.ones(5), np.zeros(5), np.zeros(0)):
        m = quality_rank.fit(x[: len(only)], only, np.arange(len(only)))
        assert 0 <= m.probability(x[0]) <= 1


def test_common_is_the_share_of_the_most_frequent_word():
    at = quality_rank.FEATURES.index("common")
    assert quality_rank.features("once upon a " + "spam " * 17)[at] == pytest.approx(17 / 20)
    assert quality_rank.features("a b c d")[at] == pytest.approx(1 / 4) and quality_rank.features("")[at] == 0


def test_classifier_learns_from_every_labelled_row(spark, monkeypatch):
    monkeypatch.setattr(quality_rank, "DEAL_ROWS", 100)
    rows = corpus(600)
    labels = [(i, int(i % 10 != 0)) for i in range(600)]
    model = quality_rank.learn(docs_frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"), driver_rows=50)
    text, ids = dict(rows), [i for i in range(600) if zlib.crc32(str(i).encode()) % 5]
    x, y = np.array([quality_rank.features(text[i]) for i in ids]), np.array([i % 10 != 0 for i in ids])
    assert (model.low == x.min(axis=0)).all() and (model.high == x.max(axis=0)).all()
    assert model.threshold == pytest.approx(np.quantile(x @ model.weights, (~y).mean(), method="midpoint"), rel=1e-6)
    # The pairs: in each round every good row once, every bad one as often as the others, give or take one.
    known = spark.createDataFrame([(i, int(g), f.tolist()) for i, g, f in zip(ids, y, x)], "doc_id long, label int, f array<double>")
    dealt = quality_rank.dealt(known, len(ids)).collect()
    diff = []
    for turn in range(quality_rank.PAIRS_PER_GOOD):
        good, bad = ({r["rank"]: np.array(r["f"]) for r in dealt if (r["round"], r["label"]) == (turn, c)} for c in (1, 0))
        assert sorted(good) == list(range(y.sum())) and sorted(bad) == list(range((~y).sum()))
        diff += [good[k] - bad[k % len(bad)] for k in good]
    scale = np.maximum(x.std(axis=0), quality_rank.LEAST_SCALE)
    d, w = np.array(diff) / scale, model.weights * scale
    assert np.abs(d.T @ (1 / (1 + np.exp(d @ w))) / len(d) - quality_rank.RIDGE * w).max() < 1e-9
    few = quality_rank.fit(x, y.astype(float), np.array(ids))
    assert [model.probability(f) >= 0.3 for f in x] == pytest.approx([few.probability(f) >= 0.3 for f in x])
    only = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, quality int")
    assert not quality_rank.learn(docs_frame(spark, rows), only, driver_rows=50).weights.any()


def test_classifier_on_held_out_rows(spark):
    rows = corpus(600) + [(None, None), (5000, ""), (7, corpus(600)[7][1])]
    labels = spark.createDataFrame([(i, int(i % 10 != 0)) for i in range(600)] + [(None, 1), (3, None), (9, 1)],
                                   "doc_id long, quality int")
    got = quality_rank.score(docs_frame(spark, rows), labels).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [(r.predicted, r.doc_id % 10 != 0) for r in got if r.held_out and r.doc_id < 600]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert quality_rank.score(docs_frame(spark, rows), labels.limit(0)).count() == len(rows)
    assert quality_rank.score(docs_frame(spark, []).limit(0), labels).count() == 0


def test_fold():
    assert toxicity.fold("L0$er") == " loser " == toxicity.fold("lоsеr")  # Cyrillic o and e
    assert toxicity.fold("Très-  bon!") == " très bon " and toxicity.fold("") == "  "


def test_exceptions_and_length():
    lex = toxicity.Lexicon({" trash ": 2.0, " lowe": 1.0}, [" trash can "])
    a = lex.automaton()
    assert toxicity.evidence(toxicity.fold("a trash can"), a)[2] == 0
    assert toxicity.evidence(toxicity.fold("trash can trash"), a)[1] == pytest.approx(2 / 3 ** 0.5)
    short, long = (toxicity.evidence(toxicity.fold("trash" + " ok" * n), a)[1] for n in (1, 30))
    assert short > long > 0
    assert toxicity.evidence(toxicity.fold("lowein flowe"), a)[1] == pytest.approx(1 / 2 ** 0.5)
    assert toxicity.evidence(" x ", toxicity.Lexicon({}).automaton())[1] == 0


def test_evidence_against_plain_search():
    r = random.Random(13)
    words = ["ab", "aba", "abab", "ba", "b", "bab", "c"]
    for _ in range(400):
        entries = {f" {w} " if r.random() < 0.5 else f" {w}": r.choice([0.5, 1.0, 2.0]) for w in r.sample(words, 3)}
        phrases = [f" {r.choice(words)} {r.choice(words)} " for _ in range(r.randint(0, 2))]
        text = toxicity.fold(" ".join(r.choice(words) for _ in range(r.randint(0, 12))))
        places = lambda e: [i for i in range(len(text)) if text.startswith(e, i)]
        spared = [(i, i + len(p) - 1) for p in phrases for i in places(p)]
        hits = {}
        for e, weight in entries.items():
            for i in places(e):
                if not any(s <= i < z for s, z in spared):
                    hits[i] = max(weight, hits.get(i, 0.0))
        n = max(len(text.split()), 1)
        got = toxicity.evidence(text, toxicity.Lexicon(entries, phrases).automaton())
        assert got == pytest.approx((1.0, sum(hits.values()) / n ** 0.5, max(hits.values(), default=0.0)))


def test_a_shared_line_does_not_join_documents(spark):
    """All labelled documents hold the same long line; copies count once, with the label that most have."""
    r = random.Random(14)
    boiler = "this page is provided as it stands " * 12
    rows, labels = [], []
    for i in range(400):
        words = prose(r, 30).split(" ")
        if i % 4 == 0:
            words.insert(r.randrange(len(words)), "gribble")
        rows.append((i, " ".join(words) + "\n" + boiler))
        labels.append((i, int(i % 4 == 0)))
    copied = "the only text with blort " * 3
    rows += [(1000 + i, copied) for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    df = docs_frame(spark, rows)
    lexicon = toxicity.learn(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert " gribble " in lexicon.entries and " blort " not in lexicon.entries
    got = {x.doc_id: x.predicted for x in toxicity.score(df, None, lexicon=lexicon).collect()}
    assert all(got[i] == (i % 4 == 0) for i in range(400))


def test_very_long_texts(spark):
    text = "fine words here " * 150_000
    rows = [(1, text), (2, text + "snark"), (3, None)]
    lexicon = toxicity.Lexicon({" snark ": 3.0}, [], (-4.0, 900.0, 0.0))
    got = {x.doc_id: x.score for x in toxicity.score(docs_frame(spark, rows), None, lexicon=lexicon).collect()}
    assert got[2] > got[1] == got[3]
    assert len(quality_rank.features(text)) == len(quality_rank.FEATURES)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert len(quality_rank.score(docs_frame(spark, rows), labels).collect()) == 3


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(8)
    bad = ["gribble", "snark", "blort"]
    rows, labels = [], []
    for i in range(800):
        toxic = i % 8 == 0
        words = prose(r, 60).split(" ")
        for _ in range(3 if toxic else 0):
            w = r.choice(bad)
            words.insert(r.randrange(len(words)), r.choice([w, w.upper(), w.replace("o", "0").replace("i", "1")]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(None, None), (9000, ""), (0, rows[0][1])]
    df, lab = docs_frame(spark, rows), spark.createDataFrame(labels + [(None, 1)], "doc_id long, toxic int")
    got = toxicity.score(df, lab).collect()
    assert len(got) == len(rows)
    for x in got:
        assert 0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3)
        assert x.held_out == (x.doc_id is not None and zlib.crc32(str(x.doc_id).encode()) % 4 == 2)
    held = [(x.predicted, x.doc_id % 8 == 0) for x in got if x.held_out and x.doc_id < 800]
    assert sum(p == t for p, t in held) >= 0.98 * len(held)
    assert toxicity.score(df, lab.limit(0)).count() == len(rows)
    assert toxicity.score(df.limit(0), lab).count() == 0
