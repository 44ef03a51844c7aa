"""Token counts and the piece codec against the libraries."""

import random

import pytest
from pyspark.sql import functions as F

from airspark.llm import piece_codec, token_counts, tokenizing, word_memo
from airspark.session import scratch_path

tokenizers = pytest.importorskip("tokenizers")
spm = pytest.importorskip("sentencepiece")

SCRAPS = ["a", "b", " ", "  ", "\n", "\n\n\n", "\t", "é", "É", "中", "😀", "the", "ing", "'s", " 's", "<|endoftext|>", "\0",
          "ß", "1", "23", "!", "...", "​", "́", "\xa0", "\x1c", "İ", "ΑΣ", "\r\n", "<|", "ı", "▁", "    ", "<s>"]
TEXTS = [None, "", " ", "one two", "one two", "a" * 5000, "word " * 60_000, "naïve\ncafé\n\n\nx ", "x<|endoftext|>y", "\n \n"]


def scraps(n, seed, most=12):
    r = random.Random(seed)
    return ["".join(r.choice(SCRAPS) for _ in range(r.randint(0, most))) for _ in range(n)]


def frame(spark, texts):
    """Ids with a NULL and repeats, and columns that clash with inner names."""
    rows = [(None if i == 3 else i // 2, t, "x", i, "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, content string, n_tokens int, row string")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_memo_gives_library_ids(name):
    lib = tokenizers.Tokenizer.from_file(tokenizing.resolve(name))
    memo = word_memo.MemoEncoder(name)
    for t in scraps(4000, 1) + [t or "" for t in TEXTS]:
        want = lib.encode(t, add_special_tokens=False).ids
        assert memo.ids(t).tolist() == want and memo.count(t) == len(want), repr(t)


def test_long_texts_are_cut_where_the_encoding_splits():
    lib = tokenizers.Tokenizer.from_file(tokenizing.resolve("byte_bpe_50k.json"))
    text = " ".join(f"w{chr(97 + i % 26)} y" for i in range(2000))
    parts = tokenizing.pieces(text, 500)
    assert len(parts) > 5 and "".join(parts) == text
    assert sum((lib.encode(p, add_special_tokens=False).ids for p in parts), []) == lib.encode(
        text, add_special_tokens=False).ids
    assert tokenizing.pieces("x" * 2000, 500) == ["x" * 2000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts(spark, name):
    df = frame(spark, TEXTS)
    got = token_counts.count_tokens(df, name, limit=3).collect()
    path = tokenizing.resolve(name)
    if name.endswith(".json"):
        lib = tokenizers.Tokenizer.from_file(path)
        count = lambda t: len(lib.encode(t, add_special_tokens=False).ids)
    else:
        sp = spm.SentencePieceProcessor(model_file=path)
        count = lambda t: len(sp.encode(t))
    want = sorted(((r.doc_id is None, r.doc_id, len((r.text or "").encode()), count(r.text or "")) for r in df.collect()),
                  key=str)
    assert sorted(((r.doc_id is None, r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 3) for r in got)
    assert token_counts.count_tokens(df.limit(0), name).count() == 0


def test_cache_is_read_before_anything_is_encoded(spark):
    cache = scratch_path(spark, "test-cache")
    df = frame(spark, TEXTS)
    token_counts.count_tokens(df, cache_path=cache).count()
    stored = spark.read.parquet(cache)
    assert stored.distinct().count() == len({t or "" for t in TEXTS})  # a row repeated whole may be stored twice
    n = stored.count()
    # A stored count is taken as it is; another tokenizer's is not.
    digest = token_counts.content_digest(F.lit("never seen"))
    (spark.range(1).select(digest.alias("content"), F.lit(tokenizing.version_digest("byte_bpe_50k.json"))
                           .alias("tokenizer"), F.lit(77).cast("long").alias("n_tokens"))
     .write.mode("append").parquet(cache))
    new = frame(spark, ["never seen", "one two"])
    assert {r.n_tokens for r in token_counts.count_tokens(new, cache_path=cache).collect()} == {77, 2}
    assert spark.read.parquet(cache).count() == n + 1  # nothing was encoded
    other = token_counts.count_tokens(new, "word_bpe_49k.json", cache_path=cache).collect()
    assert {r.n_tokens for r in other} == {2}


def test_a_warm_cache_moves_no_text(spark, monkeypatch):
    cache = scratch_path(spark, "test-cache")
    texts = [*TEXTS, *(f"text number {i}" for i in range(200))]
    df = frame(spark, texts)
    token_counts.count_tokens(df, cache_path=cache).count()
    n, seen = spark.read.parquet(cache).count(), []
    inner = token_counts._standing_for
    monkeypatch.setattr(token_counts, "_standing_for", lambda *a: seen.append(inner(*a)) or seen[-1])
    again = token_counts.count_tokens(df, cache_path=cache)
    assert again.count() == len(texts) and not seen and spark.read.parquet(cache).count() == n
    more = frame(spark, [*texts, "never seen before"])
    assert token_counts.count_tokens(more, cache_path=cache).count() == len(texts) + 1
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "BroadcastHashJoin" in plan and spark.read.parquet(cache).count() == n + 1
    keyed = df.select(token_counts.content_digest("text").alias("content"), F.lit("").alias("row"), "text")
    many = inner(keyed, keyed.select("content", "row").distinct(), 3, 10)
    assert "ShuffledHashJoin" in many._jdf.queryExecution().executedPlan().toString()


def test_codec_gives_library_ids_and_text():
    sp = spm.SentencePieceProcessor(model_file=tokenizing.resolve("piece_bpe_32k.model"))
    codec = piece_codec.PieceCodec()
    for t in scraps(3000, 2, 16) + ["", " ", "a" * 3000, "the quick brown fox " * 200]:
        ids = codec.encode(t).tolist()
        assert ids == sp.encode(t), repr(t)
        assert codec.decode(ids) == sp.decode(ids), repr(t)


def test_relaxation_keeps_the_best_sum_at_every_position():
    """The BPE path against all paths: a step counts 0 if its piece stays apart from the one before, else it is barred."""
    c = piece_codec.PieceCodec("piece_bpe_32k.model")
    assert c.is_bpe and piece_codec.model_type(tokenizing.resolve("piece_bpe_32k.model")) == piece_codec.BPE
    for word in ["\u2581the", "\u2581banana", "tion", "\u2581aaaa", "\u2581xyzzy"]:
        paths = [[]]
        done = []
        while paths:
            p = paths.pop()
            at = sum(map(len, p))
            if at == len(word):
                done.append(p)
            for z in range(at + 1, len(word) + 1):
                piece = word[at:z]
                if piece in c.score and c._stay_apart(p[-1] if p else "", piece):
                    paths.append([*p, piece])
        assert done == [c._path(word)]


def test_codec_on_tables(spark):
    df = frame(spark, TEXTS)
    enc = piece_codec.encode(df)
    rows = piece_codec.round_trip(df).collect()
    assert sorted(map(str, enc.select('doc_id', 'ids').collect())) == sorted(
        map(str, piece_codec.round_trip(df).select('doc_id', 'ids').collect()))
    assert sorted(r.decoded for r in rows) == sorted(t or "" for t in TEXTS)
    assert all(r.n_ids == len(r.ids) for r in rows)
    back = piece_codec.decode(enc.withColumn("ids", F.when(F.col("n_ids") > 2, F.col("ids")))).collect()
    assert len(back) == len(TEXTS) and all(r.text is not None for r in back)
    assert piece_codec.encode(df.limit(0)).count() == 0


def test_unigram_path_is_the_best_sum(monkeypatch):
    import re
    import ahocorasick
    r = random.Random(4)
    score = {c: -8.0 - r.random() for c in "abcd"}
    for _ in range(40):
        score["".join(r.choice("abcd") for _ in range(r.randint(2, 4)))] = -3.0 - 6 * r.random()
    c = piece_codec.PieceCodec.__new__(piece_codec.PieceCodec)
    c.score, c.is_bpe, c._strangers = score, False, re.compile("([^abcd])")
    c.automaton = ahocorasick.Automaton()
    for p in score:
        c.automaton.add_word(p, (len(p), p, {}))
    c.automaton.make_automaton()

    def best(word):
        if not word:
            return 0.0
        return max(score[word[:n]] + best(word[n:]) for n in range(1, 5) if word[:n] in score)

    for _ in range(60):
        word = "".join(r.choice("abcd") for _ in range(r.randint(1, 9)))
        path = c._path(word)
        assert "".join(path) == word and sum(score[p] for p in path) == pytest.approx(best(word))
