"""Token files: exact round trips. Packing: every id once, windows full and on target."""
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bidtide.llm import packing, tokens

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def direct(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_piecewise_ids_equal_the_library(path):
    encoder, plain = tokens.PieceIds.of(path), direct(path)

    @settings(max_examples=300, deadline=None)
    @given(st.text(st.sampled_from("ab éÉ'st0,. \n\t  ́\x1c<|>|Σςİ"), max_size=40))
    def check(text):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain(text)

    check()
    for text in ("a  b   c \n d", "it's don't 12 ", "<|endoftext|> x", " ", "x" * 500, "a İ. İİ b! ǅ: ﬁ", " ".join(map(chr, range(0xC0, 0x250)))):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain(text)


@given(st.lists(st.integers(0, 2**20 - 1), min_size=1, max_size=60), st.integers(20, 25), st.data())
def test_bit_packing_round_trip(ids, bits, data):
    payload = tokens.pack(np.array(ids, np.uint32), bits)
    assert len(payload) == -(-len(ids) * bits // 8) and tokens.unpack(payload, bits, len(ids)).tolist() == ids
    first = data.draw(st.integers(0, len(ids) - 1))
    assert tokens.unpack(payload, bits, len(ids) - first, first).tolist() == ids[first:]
    assert tokens.bits_for(49_408) == 16 and tokens.bits_for(2) == 1 and tokens.bits_for(65_537) == 17


def test_files_give_back_all_ids_in_order(spark, table, docs):
    texts = table("documents").select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    path = tokens.write_tokens(texts, WORDS, 2, block_ids=500)
    plain, start = direct(WORDS), 0
    rows = sorted(tokens.read_tokens(spark, path).collect(), key=lambda r: r.start)
    wanted = sorted(((r.doc_id, r.text or "") for r in texts.collect()), key=lambda r: (r[0] is not None, r))
    assert len(rows) == len(wanted)
    for row, (doc_id, text) in zip(rows, wanted):
        ids = [*plain(text), 2]
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(ids)) and np.frombuffer(row.ids, "<u4").tolist() == ids
        start += len(ids)
    first = spark.read.parquet(path).orderBy("shard").first().shard
    assert tokens.id_at(spark, path, first, 1) == (np.frombuffer(rows[0].ids, "<u4").tolist() + np.frombuffer(rows[1].ids, "<u4").tolist())[1]
    assert tokens.read_tokens(spark, tokens.write_tokens(docs.limit(0), WORDS, 2)).count() == 0


def packed(frame):
    rows, lanes = frame.collect(), defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length
        lanes[r.sequence_id].append((r.offset, r.length, r.queue))
    for lane in lanes.values():
        at = 0
        for offset, length, _ in sorted(lane, key=lambda x: x[:2]):
            assert offset == at
            at += length
        assert at <= 1024 and at & (at - 1) == 0
    return rows, lanes


def test_every_id_lies_in_one_piece(spark, table, docs):
    texts = table("documents").select("doc_id", "text", "source").unionByName(docs.select("doc_id", "text", "source").where("doc_id is null or doc_id > 1"))
    texts = texts.where("doc_id is null or doc_id > 8").repartition(5)
    rows, lanes = packed(packing.pack(texts, BYTES))
    plain, pieces = direct(BYTES), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.ids, r.doc_tokens))
    for r in texts.collect():
        joined = b"".join(ids for _, ids, _ in sorted(pieces[r.doc_id]))
        wanted = [*plain(r.text), 0]
        assert np.frombuffer(joined, "<u4").tolist() == wanted and {n for *_, n in pieces[r.doc_id]} == {len(wanted)}
    assert sorted(lanes) == list(range(len(lanes))) and sum(sum(n for _, n, _ in lane) < 1024 for lane in lanes.values()) <= 10
    shares = defaultdict(int)
    for lane in lanes.values():
        for _, n, q in lane:
            shares[q] += n
    total = sum(shares.values())
    for number, lane in lanes.items():
        if sum(n for _, n, _ in lane) == 1024 and number < total // 1024:
            got = defaultdict(int)
            for _, n, q in lane:
                got[q] += n
            assert all(abs(got[q] - 1024 * n / total) < 3 for q, n in shares.items())
    whole = {r.sequence_id: r.ids for r in packing.sequences(packing.pack(texts, BYTES)).collect()}
    assert zlib.crc32(b"".join(whole[i] for i in sorted(whole))) and all(len(whole[i]) == 4 * sum(n for _, n, _ in lanes[i]) for i in lanes)


def test_weights_hold_until_a_queue_is_empty(spark):
    docs = spark.createDataFrame([(i, "x " * 400, "a" if i % 4 else "b") for i in range(60)], "doc_id long, text string, source string")
    rows, lanes = packed(packing.pack(docs, BYTES, weights={"a": 1.0, "b": 1.0}))
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)
    for number in range(5):
        assert sum(n for _, n, q in lanes[number] if q == "a") == 512
    assert packing.pack(docs.limit(0), BYTES).count() == 0
    many, _ = packed(packing.pack(docs.selectExpr("doc_id", "text", "cast(doc_id as string) as source"), BYTES, max_queues=7))
    assert sum(r.length for r in many) == sum(r.length for r in rows)


@given(st.lists(st.integers(0, 40), min_size=1, max_size=6), st.lists(st.floats(0, 5), min_size=6, max_size=6), st.booleans())
def test_schedule_never_goes_back(totals, weights, weighted):
    plan = packing.Schedule(totals, weights[: len(totals)] if weighted else None)
    served = plan.served(np.arange(sum(totals) + 1))
    assert (np.diff(served, axis=0) >= 0).all() and served.sum(axis=1).tolist() == list(range(sum(totals) + 1)) and served[-1].tolist() == totals


@pytest.mark.parametrize("name,edge", [("byte_bpe_50k.json", "start"), ("word_bpe_49k.json", "end")])
def test_words_are_cut_where_ids_show_their_edges(monkeypatch, name, edge):
    path = public_tokenizers.path(name)
    pieces = tokens.PieceIds(path)
    assert pieces.edge == edge
    monkeypatch.setattr(tokens, "TOGETHER", 7)
    texts = ["", " ", "one", *[f"word{'xyzq' * (i % 5)} né{chr(97 + i % 26)}straße, И{chr(1072 + i % 32)}о 漢字 {i}a it's. the İi" for i in range(60)], "the one word " * 40]
    plain = tokens.PieceIds(path).tokenizer
    assert pieces.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_texts_that_wait_for_new_pieces_keep_their_places(monkeypatch):
    for path in (WORDS, BYTES):
        plain = direct(path)
        texts = ["one two three", "one two three", "", " ", "new words here, one two", "x" * 100 + " one", "one " + "y" * 100, "one\ntwo three", " two one", "one  two", "two three one"] * 3 + ["last thing said"]
        wanted = [plain(t) for t in texts]
        for together, held, limit in ((1, 1, 3), (2, 4, 5), (1024, 3, 100), (1024, 10_000, 1)):
            monkeypatch.setattr(tokens, "TOGETHER", together)
            monkeypatch.setattr(tokens, "HELD", held)
            pieces = tokens.PieceIds(path)
            pieces.limit = limit
            assert [np.frombuffer(b, "<u4").tolist() for b in pieces.encode(texts)] == wanted


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_words_with_signs_and_line_breaks_are_learnt_as_words(path):
    """A word met with other signs or across a line break costs no call of its own, and ids stay the library's."""
    words = [f"Wo{a}{b}rd\u00e9" for a in "abcdefghij" for b in "klmnopqrst"]
    texts = [f"x {w} {w}*** {w}_. {w}.\n{w} {w}!!\n{w}?\n\u00c9{w} {w}\n's" for w in words] + ["a \u0130b \u0130b. c\u0301. d.\u0301 e\n\u0301f g\r\nh i\n\nj 1. <|endoftext|>\nk", "a b\x1cc\nd \u3000e\u2028f."]
    pieces = tokens.PieceIds(path)
    asked, encoded = [], pieces._encoded
    pieces._encoded = lambda given: asked.extend(given) or encoded(given)
    plain = direct(path)
    assert pieces.encode(texts) == [np.array(plain(t), "<u4").tobytes() for t in texts]
    assert len(asked) <= 3 * len(words)


def test_pieces_met_again_outlive_those_met_once():
    pieces = tokens.PieceIds(BYTES)
    pieces.limit = 40
    learnt, learn = [], pieces._learn
    pieces._learn = lambda fresh: learnt.extend(fresh) or learn(fresh)
    for i in range(60):
        pieces.encode([f"x often again n{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}w"])
        assert len(pieces.after_space) + len(pieces.older) <= pieces.limit + 4
    assert learnt.count("often") == 1 and len(set(learnt)) == 62


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_a_piece_is_looked_up_once_for_many_texts_and_plain_words_skip_patterns(path):
    words = [f"W{a}{b}rdé­"[:5] for a in "abcdefghij" for b in "klmnopqrst"]
    texts = [f"{w} {' '.join(words)}.\n{w} {' '.join(words)}" for w in words]
    pieces = tokens.PieceIds(path)
    asked, encoded, known, looked = [], pieces._encoded, pieces._known, []
    pieces._encoded = lambda given: asked.extend(given) or encoded(given)
    pieces._known = lambda given: looked.extend(given) or known(given)
    plain = direct(path)
    assert pieces.encode(texts) == [np.array(plain(t), "<u4").tobytes() for t in texts]
    assert len(looked) <= 3 * len(words) and len([w for w in asked if " " not in w]) <= len(words) + 10


def test_ids_are_not_dealt_out_for_few_queues(spark, monkeypatch):
    rows = [(i, f"s{i % 3}", "some words to pack " * (i % 7)) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pieces = packing.pack(frame, BYTES, width=64)
        assert "SortMergeJoin" not in pieces._jdf.queryExecution().executedPlan().toString()
        few = sum(r.length for r in pieces.collect())
        monkeypatch.setattr(packing, "BROADCAST_ROWS", 0)
        dealt = sum(r.length for r in packing.pack(frame, BYTES, width=64).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert few == dealt > 0
