from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from weftmill import fixtures
from weftmill.functions.bytesym import encoder_rows, encoder_table, symbols
from weftmill.lineage import cut
from weftmill.operators import bpe, text, tokens


def byte_vocab(spark, extra):
    rows = [(b, c) for c, b in encoder_rows()] + list(extra)
    return spark.createDataFrame(rows, "token int, cluster string")


def naive_steps(part, vocab):
    """Plain pair-by-pair merging: list of (token, symbols) states."""
    character = {b: c for c, b in encoder_rows()}
    state = [character[b] for b in part.encode()]
    steps = [(None, state)]
    while True:
        known = [vocab[a + b] for a, b in zip(state, state[1:]) if a + b in vocab]
        if not known:
            return steps
        best, merged, i = min(known), [], 0
        while i < len(state):
            if i + 1 < len(state) and vocab.get(state[i] + state[i + 1]) == best:
                merged.append(state[i] + state[i + 1])
                i += 2
            else:
                merged.append(state[i])
                i += 1
        state = merged
        steps.append((best, state))


@pytest.fixture(scope="module")
def random_case(spark):
    """Words over a tiny alphabet, so that overlaps and repeats are common, and a vocabulary whose
    ids are not in order of length."""
    rng = random.Random(7)
    words = {"".join(rng.choice("abé ") for _ in range(rng.randint(1, 14))) for _ in range(400)}
    words |= {"".join(rng.choice("ab") for _ in range(rng.randint(58, 150))) for _ in range(40)}
    character = {b: c for c, b in encoder_rows()}
    pieces = set()
    for w in sorted(words):
        s = "".join(character[b] for b in w.encode())
        for _ in range(2):
            n = rng.randint(2, 5)
            at = rng.randrange(max(1, len(s) - n))
            pieces.add(s[at : at + n])
    extra = [p for p in sorted(pieces) if len(p) > 1][:150]
    rng.shuffle(extra)
    rows = [(1000 + i, p) for i, p in enumerate(extra)]
    lookup = {p: t for t, p in rows}
    return (
        spark.createDataFrame([(w,) for w in sorted(words)], "part string"),
        byte_vocab(spark, rows),
        {w: naive_steps(w, lookup) for w in words},
    )


def merged(df):
    out = {}
    for r in df.orderBy("part", "position").collect():
        out.setdefault(r["part"], []).append(r["cluster"])
    return out


@pytest.mark.parametrize("long_part", [62, 0])
def test_merge_equals_naive_merge(random_case, monkeypatch, long_part):
    """Array functions, the long-part function, and both by length."""
    monkeypatch.setattr(bpe, "LONG_PART", long_part)
    parts, vocab, expected = random_case
    assert merged(bpe.bpe_merge(parts, vocab)) == {w: s[-1][1] for w, s in expected.items()}


def test_merge_with_vocabulary_beyond_broadcast(random_case, monkeypatch):
    monkeypatch.setattr(bpe, "fits", lambda *a, **k: False)
    parts, vocab, expected = random_case
    assert merged(bpe.bpe_merge(parts, vocab)) == {w: s[-1][1] for w, s in expected.items()}


@pytest.mark.parametrize("long_part", [62, 0])
def test_trace_equals_naive_merge(random_case, monkeypatch, long_part):
    monkeypatch.setattr(bpe, "LONG_PART", long_part)
    parts, vocab, expected = random_case
    found = {}
    for r in bpe.bpe_trace(parts, vocab).orderBy("part", "step").collect():
        found.setdefault(r["part"], []).append((r["token"], r["symbols"]))
    assert found == expected


@pytest.mark.parametrize("n", [1, 2, 60, 61, 62, 63, 64, 65, 1000])
def test_merge_and_trace_at_every_length(spark, n):
    """Lengths around the switch from one BIGINT of boundaries to the heap."""
    rows = [(300, "ab"), (301, "ba"), (302, "abab"), (299, "bb")]
    part = "".join(random.Random(n).choice("ab") for _ in range(n))
    parts, vocab = spark.createDataFrame([(part,)], "part string"), byte_vocab(spark, rows)
    expected = naive_steps(part, {c: t for t, c in rows})
    assert merged(bpe.bpe_merge(parts, vocab)) == {part: expected[-1][1]}
    found = bpe.bpe_trace(parts, vocab).orderBy("step").collect()
    assert [(r["token"], r["symbols"]) for r in found] == expected


def test_merge_of_a_huge_part(spark):
    """Far from quadratic: a quadratic way takes hours here."""
    rows = [(300 + i, "ab" * 2**i) for i in range(7)] + [(299, "ba")]
    part = "ab" * 50_000
    found = bpe.merge_parts(spark.createDataFrame([(part,)], "part string"), byte_vocab(spark, rows)).first()
    assert "".join(found["clusters"]) == part
    assert found["clusters"] == ["a", *["ba"] * 49_999, "b"]


def test_merge_long_parts_query_equals_naive_merge(spark, sf_dir):
    import hashlib
    import re

    import __spark_entry__ as entry_module

    vocab = entry_module._vocab(spark, sf_dir)
    known = {r["cluster"]: r["token"] for r in vocab.collect()}
    found = {r["part_md5"]: r for r in entry_module.q_bpe_merge_long_parts(spark, sf_dir).collect()}
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    parts = {re.sub(r"\s", "", t) for t in texts} - {""}
    assert len(found) == len(parts)
    for part in sorted(parts, key=len)[:40]:
        clusters = naive_steps(part, known)[-1][1]
        row = found[hashlib.md5(part.encode()).hexdigest()]
        assert row["n_clusters"] == len(clusters)
        assert row["clusters_md5"] == hashlib.md5(" ".join(clusters).encode()).hexdigest()


@pytest.mark.parametrize(
    "value, parts",
    [
        ("語。\u3000次", ["語", "。", "\u3000", "次"]),
        ("a!\u00a0b", ["a", "!\u00a0", "b"]),
        ("a\u2028\u0085b", ["a", "\u2028\u0085", "b"]),
    ],
)
def test_blanks_beyond_ascii(spark, value, parts):
    rows = text.pretokenize(spark.createDataFrame([(1, value)], "id int, t string"), "t", ["id"])
    assert [r["part"] for r in rows.orderBy("part_position").collect()] == parts


def test_decode_sequences_equals_detokenize(spark, monkeypatch):
    vocab = byte_vocab(spark, [(300, "ab")])
    rows = [(1, [300, 97, 0, 300]), (2, []), (3, [999]), (4, None), (5, [195]), (6, [195, 169])]
    df = spark.createDataFrame(rows, "id int, input array<int>")
    decoded = {r["id"]: (bytes(r["bytes"]), r["response"]) for r in tokens.decode_sequences(df, vocab, "input", ["id"]).collect()}
    assert decoded == {
        1: (b"aba\0ab", "aba\0ab"), 2: (b"", ""), 3: (b"", ""), 5: (b"\xc3", None), 6: ("é".encode(), "é"),
    }
    each = df.select("id", F.posexplode("input").alias("ordinality", "token"))
    plain = {r["id"]: (bytes(r["bytes"]), r["response"]) for r in tokens.detokenize(each, vocab, ["id"]).collect()}
    assert plain == {k: v for k, v in decoded.items() if k not in (2, 3)}


def test_trace_of_word(spark):
    vocab = byte_vocab(spark, [(300, "ss"), (301, "is"), (302, "iss"), (303, "Miss")])
    parts = spark.createDataFrame([("Mississippilessly",)], "part string")
    rows = bpe.bpe_trace(parts, vocab).orderBy("step").collect()
    assert [r["combined"] for r in rows] == [None, "ss", "iss", "Miss"]
    assert rows[-1]["symbols"] == ["Miss", "iss", "i", "p", "p", "i", "l", "e", "ss", "l", "y"]


@pytest.mark.parametrize(
    "value, parts",
    [
        ("", []),
        ("x", ["x"]),
        ("a   b", ["a", "   ", "b"]),
        ("don't_1 !!", ["don", "'t", "_1", " !!"]),
        ("Spark3 is great", ["Spark3", " is", " great"]),
        ("we'll'x", ["we", "'ll", "'", "x"]),
        ("été 𝒳 日本\n\n z", ["été", " 𝒳", " 日本", "\n\n ", "z"]),
        ("a_1 2", ["a_1", " 2"]),
    ],
)
def test_parts(spark, value, parts):
    df = spark.createDataFrame([(1, value)], "id int, t string")
    rows = text.pretokenize(df, "t", ["id"]).orderBy("part_position").collect()
    assert [r["part"] for r in rows] == parts
    assert [r["part_position"] for r in rows] == list(range(1, len(parts) + 1))


def test_byte_map(spark):
    rows = dict((b, c) for c, b in encoder_rows())
    assert len(rows) == len(set(rows.values())) == 256
    assert (rows[0], rows[32], rows[65], rows[173], rows[255]) == ("Ā", "Ġ", "A", "Ń", "ÿ")
    every = "".join(map(chr, range(256))) + "日𝒳"
    df = spark.createDataFrame([(every,)], "t string").select(symbols("t").alias("s"))
    assert df.first()["s"] == "".join(rows[b] for b in every.encode())
    assert encoder_table(spark).count() == 256


@pytest.fixture(scope="module")
def skewed(spark):
    """One part is a third of all occurrences, one text holds most of the parts."""
    rows = [(1, "the " * 3000), (2, ""), (3, "naïve\0 'tis 𝒳!\0\0"), (4, " ".join(f"w{i}" for i in range(6000)))]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_round_trip(spark, skewed):
    vocab = byte_vocab(spark, [(300, "th"), (301, "the"), (302, "Ġthe"), (303, "Ġth")])
    out = tokens.roundtrip_check(skewed, "text", ["doc_id"], ["doc_id"], vocab).collect()
    assert {r["doc_id"]: r["n_different"] for r in out} == {1: 0, 2: 0, 3: 0, 4: 0}


def test_dictionary_beyond_broadcast(spark, skewed, monkeypatch):
    vocab = byte_vocab(spark, [(300, "th"), (301, "the")])
    dictionary = tokens.part_dictionary(skewed, "text", vocab)
    occurrences = cut(text.pretokenize(skewed, "text", ["doc_id"]))
    small = tokens._with_tokens(occurrences, dictionary)
    monkeypatch.setattr(tokens, "HEAVY_PARTS", 4)
    large = tokens._with_tokens(occurrences, dictionary, max_rows=10)
    assert small.count() == occurrences.count()
    assert small.exceptAll(large.select(small.columns)).isEmpty()
    assert large.count() == occurrences.count()
    assert "BroadcastHashJoin" not in tokens._with_tokens(
        occurrences, dictionary.filter("n < 2"), max_rows=10
    )._jdf.queryExecution().optimizedPlan().toString()


def test_sequences_keep_order_over_chunks(spark, skewed, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNK", 7)
    vocab = byte_vocab(spark, [])
    expected = {r["doc_id"]: list(r["text"].encode()) for r in skewed.collect() if r["text"]}
    direct = tokens.text_sequences(skewed, "text", ["doc_id"], vocab)
    rows = tokens.tokenize(skewed, "text", ["doc_id"], vocab)
    for df in (direct, tokens.token_sequences(rows, ["doc_id"])):
        assert {r["doc_id"]: list(r["input"]) for r in df.collect()} == expected


def test_unknown_symbols_drop(spark):
    vocab = spark.createDataFrame([(0, "a"), (1, "c")], "token int, cluster string")
    df = spark.createDataFrame([(1, "abc"), (2, "bb")], "doc_id int, text string")
    rows = tokens.tokenize(df, "text", ["doc_id"], vocab).orderBy("position").collect()
    assert [(r["doc_id"], r["position"], r["cluster"]) for r in rows] == [(1, 1, "a"), (1, 3, "c")]
    assert [r["doc_id"] for r in tokens.text_sequences(df, "text", ["doc_id"], vocab).collect()] == [1]


def test_cut_character_decodes_to_null(spark):
    vocab = byte_vocab(spark, [])
    rows = spark.createDataFrame(
        [(1, 0, 0xC3), (2, 0, 0xC3), (2, 1, 0xA9), (3, 0, 65), (3, 1, 9999)], "id int, ordinality int, token int"
    )
    out = {r["id"]: (bytes(r["bytes"]), r["response"]) for r in tokens.detokenize(rows, vocab, ["id"]).collect()}
    assert out == {1: (b"\xc3", None), 2: ("é".encode(), "é"), 3: (b"A", "A")}
    odd = spark.createDataFrame([(7, "a日b")], "token int, cluster string")
    row = tokens.detokenize(rows.withColumn("token", F.lit(7)).filter("id = 1"), odd, ["id"]).first()
    assert row["response"] == "ab"
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING"):
        tokens.detokenize(rows, vocab, ["id"], on_invalid="raise").collect()


def test_token_stats(spark):
    vocab = byte_vocab(spark, [(300, "aa")])
    df = spark.createDataFrame([("x", "aaa b"), ("x", "aa"), ("y", "")], "g string, text string")
    out = {r["g"]: r for r in tokens.token_stats(df, "text", ["g"], vocab).collect()}
    assert (out["x"]["n_tokens"], out["x"]["n_chars"], out["x"]["n_distinct"]) == (5, 7, 4)
    assert (out["y"]["n_tokens"], out["y"]["tokens_per_char"]) == (0, None)
    top = tokens.top_tokens(df, "text", ["g"], vocab, 1).collect()
    assert [(r["g"], r["token"], r["n"]) for r in top] == [("x", 300, 2)]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_merge_plan_has_one_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = bpe._hits(text.distinct_parts(docs, "text"), byte_vocab(spark, [(300, "th")]), ["n"])
    assert exchanges(found) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in plan and "BroadcastHashJoin" in plan


def test_part_counts_combine_before_the_shuffle(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = text.distinct_parts(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_kept_dictionary_merges_only_unseen_parts(spark, tmp_path):
    """A second corpus, and a second session over the same folder, merge what is new to them."""
    from weftmill.functions.bytesym import encoder_rows
    from weftmill.operators.dictionary import PartDictionary

    words = [(b, c) for c, b in encoder_rows()] + [(300, "ab"), (301, "abc")]
    vocab = spark.createDataFrame(words, "token int, cluster string")
    corpus = lambda *texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    first, second = corpus("abc ab", "xyz"), corpus("abc abd", "xyz xyz abc")
    kept = PartDictionary(spark, str(tmp_path), vocab)
    assert kept.extend(tokens.distinct_parts(first, "text")) == 3
    assert PartDictionary(spark, str(tmp_path), vocab).extend(tokens.distinct_parts(second, "text")) == 3
    assert kept.extend(tokens.distinct_parts(second, "text")) == 0
    with_kept = tokens.text_sequences(second, "text", ["id"], vocab, kept)
    assert sorted(map(str, with_kept.collect())) == sorted(map(str, tokens.text_sequences(second, "text", ["id"], vocab).collect()))
    # Another vocabulary never gets these entries.
    other = PartDictionary(spark, str(tmp_path), vocab.filter("token <> 301"))
    assert other.table.count() == 0
    assert other.entries(second, "text").filter("part = 'abc'").first()["clusters"] == ["ab", "c"]


def test_texts_are_tokenised_where_they_lie(spark):
    df = spark.createDataFrame([(1, "ab ab"), (2, None), (3, "b")], "doc_id long, text string")
    vocab = fixtures.prefix_vocab(df, "text", 5)
    plan = tokens.text_sequences(df, "text", ["doc_id"], vocab)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_texts_of_one_id_are_put_together_by_part(spark):
    rows = [(1, "ab ab c"), (1, "b ab"), (None, "c"), (None, "a c"), (2, "ab"), (3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    vocab = fixtures.prefix_vocab(df, "text", 5)
    found = tokens.text_sequences(df, "text", ["doc_id"], vocab).collect()
    expected = tokens._grouped_sequences(df, "text", ["doc_id"], vocab).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, expected), key=str) and len(found) == 3


def test_runs_of_token_rows(spark):
    """In any order, with gaps and with ordinalities that occur twice."""
    vocab = spark.createDataFrame([(i, c) for i, c in enumerate("abc")], "token int, cluster string")
    rows = [(1, 0, 0), (1, 1, 1), (1, 2, 2), (2, 5, 1), (2, 4, 0), (1, 0, 1), (1, 1, 0), (3, 0, 9), (3, 4097, 2), (3, 1, 0)]
    df = spark.createDataFrame(rows, "doc_id long, ordinality int, token int").coalesce(1)
    found = {r["doc_id"]: r["response"] for r in tokens.detokenize(df, vocab, ["doc_id"]).collect()}
    assert found == {1: "ababc", 2: "ab", 3: "ac"}
    one_by_one = spark.createDataFrame([(1, i, i % 3) for i in range(9000)], "doc_id long, ordinality int, token int")
    assert tokens.detokenize(one_by_one, vocab, ["doc_id"]).first()["response"] == "abc" * 3000
    runs = tokens._runs(one_by_one.coalesce(1).withColumn("cluster", F.lit("a")), ["doc_id"])
    assert runs.count() <= 4


@pytest.mark.parametrize("square, most", [(0, 1 << 20), (1 << 22, 1), (1 << 22, 40)])
def test_parts_merged_together_equal_each_alone(monkeypatch, square, most):
    import random

    import pyarrow as pa

    from weftmill.functions import merging
    from weftmill.functions.bytesym import encoder_rows

    monkeypatch.setattr(merging, "SQUARE_PAIRS", square)
    monkeypatch.setattr(merging, "SLICE_SYMBOLS", most)
    letters, rng = {b: c for c, b in encoder_rows()}, random.Random(2)
    draw = lambda low, high: bytes(rng.choice(b"abc\x00\xc3") for _ in range(rng.randint(low, high)))
    for _ in range(20):
        words = {"".join(letters[b] for b in draw(2, 6)) for _ in range(20)}
        known = dict(zip(sorted(words), rng.sample(range(300), len(words))))
        parts = [draw(0, 40) for _ in range(20)]
        clusters, _ids = merging.clusters_and_tokens(merging.PairTable(known.items()), pa.array(parts, pa.binary()))
        for part, found in zip(parts, clusters.to_pylist()):
            s = "".join(letters[b] for b in part)
            bounds = bpe._merged(len(s), lambda i, j, s=s: known.get(s[i:j]) if j - i > 1 else None)["bounds"]
            assert found == [s[a:b] for a, b in zip(bounds, bounds[1:])]
