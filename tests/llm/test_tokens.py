import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import awkward_docs, empty_docs
from trolley.llm.common import stage_path
from trolley.llm.packing import first_basis, knapsack, line_cuts, pack, place_remainder, round_plan, sequences
from trolley.llm.token_counts import line_sections, token_counts
from trolley.llm.token_output import ShardReader, read_documents, write_tokens
from trolley.llm import tokens
from trolley.llm.tokens import Encoder, encoder, vocabulary, widen

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"


def plain(name):
    t = Tokenizer.from_file(vocabulary(name))
    t.encode_special_tokens = True
    return t


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_unknown_chunks_of_many_texts_are_encoded_together(name, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_ENTRIES", 50)
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 400)
    monkeypatch.setattr(tokens, "CALL_CHUNKS", 7)
    rng = random.Random(9)
    words = ["Zoë", "naïveté", "x1,y", "don't", "漢字", "ÀÁ", "a\x01b", "c\x02", "\x1c", "e\u0301", "w" * 70, "\n", ""]
    words += ["".join(rng.choices("abzéßÿÀ1.,-", k=rng.randint(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 30))) for _ in range(200)]
    enc, tok = Encoder(vocabulary(name)), plain(name)
    assert enc.plain is not None
    got = list(enc.encode_all(texts))
    assert len(got) == len(texts)
    for text, ids in zip(texts, got):
        assert np.frombuffer(widen(ids, enc.dtype), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(enc.young) < 400 and not any(len(c) > tokens.LONGEST_KEPT for c in (*enc.young, *enc.old))


@pytest.mark.parametrize("name", [WORDS, BYTES])
def test_chunked_encoding_is_the_librarys(name):
    rng = random.Random(4)
    alphabet = list("aAbzHhJİK\u0331\u030c09'!#. \n\t\r  　\x1cé́ßİ漢🙂|<>") + ["'s", "  ", "<|endoftext|>", "don't", " the"]
    enc, tok = encoder(vocabulary(name)), plain(name)
    for i in range(1600):
        if i == 800:  # mostly plain letters, digits and signs, which go to the model part by part
            alphabet = [*"aZéÀßñ09.,-_'!|<> ", " the", "ing", "\n", "漢"]
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        ref = tok.encode(text, add_special_tokens=False)
        assert np.frombuffer(widen(enc.encode(text), enc.dtype), "<u4").tolist() == ref.ids, repr(text)
        assert [tuple(x) for x in enc.spans(text).tolist()] == ref.offsets or name == WORDS, repr(text)


def test_a_word_is_one_chunk_whatever_signs_follow():
    enc, tok = Encoder(vocabulary(BYTES)), plain(BYTES)
    words = ["the", "naïve", "Größe", "x", "2024"]
    ends = ["", ",", ".", "...", "!?", ";", ":", ")", "***", "###", "$$$", "'", "'s", "'s,", "'.", "漢", "\u0301", "7a", "_b", "²"]
    text = " ".join(w + e for w in words for e in ends) + " (the) \n the\u00a0the.the,'the"
    ref = tok.encode(text, add_special_tokens=False)
    assert np.frombuffer(widen(enc.encode(text), enc.dtype), "<u4").tolist() == ref.ids
    # The words, the ends, and those that can't be parted for sure: not every word with every end.
    assert len(enc.young) < 0.6 * len(words) * len(ends)


def ids_of(tok, text, end):
    return np.array([*tok.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_token_files_round_trip(spark):
    docs = awkward_docs(spark)
    folder = stage_path(spark, "t")
    index = write_tokens(docs, vocabulary(WORDS), folder, seq_len=64, batch_rows=4)
    got = sorted(read_documents(index).collect(), key=lambda r: r["start"])
    tok, at = plain(WORDS), 0
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
    for r, want in zip(got, rows, strict=True):
        ids = ids_of(tok, want["text"], 1)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (want["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    # Random access: any sequence is ids, then padding that the mask names.
    for p in {r["path"] for r in index.collect()}:
        reader = ShardReader(p)
        n = sum(r["n_tokens"] for r in index.where(index.path == p).collect())
        for i in range(-(-n // 64)):
            ids, mask = reader.sequence(i)
            assert len(ids) == 64 and sum(mask.to_pylist()) == min(64, n - 64 * i)


def test_knapsack_and_basis():
    lengths = np.array([3, 5, 7])
    value, counts = knapsack(np.array([0.3, 0.55, 0.8]), lengths, 13)
    assert value == pytest.approx(1.4) and int(counts @ lengths) <= 13
    B, x = first_basis(np.array([4, 2, 9]), lengths, 13)
    assert np.allclose(B @ x, [4, 2, 9]) and abs(np.linalg.det(B)) > 1e-9


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_remainder_once(seed):
    rng = random.Random(seed)
    cap = rng.choice([16, 64])
    hist = {k: rng.randint(0, 30) for k in range(1, cap) if rng.random() < 0.7}
    plan = round_plan(hist, cap)
    filled = {}
    for k, n in hist.items():
        for r in range(n):
            parts = place_remainder(plan, k, r)
            assert sum(p[1] for p in parts) == k and [p[0] for p in parts] == [sum(q[1] for q in parts[:i]) for i in range(len(parts))]
            for _, size, seq, off in parts:
                filled.setdefault(seq, []).append((off, size))
    for seq, parts in filled.items():
        at = 0
        for off, size in sorted(parts):
            assert off == at
            at += size
        assert at == cap or (at & (at - 1)) == 0
    assert sorted(filled) == list(range(plan.pattern_sequences + plan.line_tokens // cap + len(line_cuts(plan))))


def test_pack_contract(spark):
    docs = awkward_docs(spark)
    out = pack(docs, vocabulary(BYTES), keep_ids=True)
    rows, tok = out.collect(), plain(BYTES)
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, ids_of(tok, r["text"], 0).tobytes()) for r in docs.collect())
    by_seq, pieces = {}, {}
    for r in rows:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        by_seq.setdefault(r["sequence_id"], []).append(r)
        pieces.setdefault((r["doc_id"] is None, r["doc_id"] or 0), []).append(r)
    assert set(pieces) == {w[:2] for w in want}
    for key, mine in pieces.items():
        # Rows of one doc_id repeat one text here: every id lies in as many pieces as there are rows.
        ids = [w[2] for w in want if w[:2] == key]
        assert len(set(ids)) == 1
        held = np.zeros(len(ids[0]) // 4, int)
        for r in mine:
            assert r["ids"] == ids[0][4 * r["start"] : 4 * (r["start"] + r["length"])] and r["doc_tokens"] == len(held)
            held[r["start"] : r["start"] + r["length"]] += 1
        assert (held == len(ids)).all()
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    seqs = sequences(out).collect()
    assert all(len(s["ids"]) == 4 * s["length"] for s in seqs) and len(seqs) == len(by_seq)
    padding = sum(s["padded_length"] - s["length"] for s in seqs)
    assert padding <= 0.01 * sum(s["length"] for s in seqs)


def test_token_counts_add_up(spark):
    docs = awkward_docs(spark)
    tok = plain(BYTES)
    want = {}
    for r in docs.collect():
        want[r["doc_id"]] = want.get(r["doc_id"], 0) + len(tok.encode(r["text"] or "", add_special_tokens=False).ids)
    for rule in ("start", "majority"):
        got = {}
        for r in token_counts(docs, vocabulary(BYTES), rule=rule).collect():
            got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["n_tokens"]
        assert got == want
    split = token_counts(docs, vocabulary(BYTES)).groupBy().sum("n_tokens", "n_tokens_split").first()
    assert split[0] == pytest.approx(split[1])


def test_token_counts_crossing(spark):
    """A section border inside a token: brute force over characters."""
    text = "hello world again"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = plain(BYTES).encode(text, add_special_tokens=False).offsets
    cut = [0, 8, 13]
    got = sorted(token_counts(docs, vocabulary(BYTES), sections=lambda t: cut).collect(), key=lambda r: r["section"])
    for i, r in enumerate(got):
        lo, hi = cut[i], [*cut[1:], len(text)][i]
        assert r["n_tokens"] == sum(lo <= a < hi for a, _ in spans)
        assert r["n_crossing"] == sum(lo <= a < hi < b for a, b in spans)
        assert r["n_tokens_split"] == pytest.approx(sum(max(0, min(b, hi) - max(a, lo)) / (b - a) for a, b in spans))
    assert line_sections("a\nb\n\nc\n") == [0, 2, 4, 5] and line_sections("") == [0]


def test_empty(spark):
    docs = empty_docs(spark)
    assert pack(docs, vocabulary(BYTES)).count() == 0
    assert token_counts(docs, vocabulary(BYTES)).count() == 0
    assert read_documents(write_tokens(docs, vocabulary(WORDS), stage_path(spark, "t"))).count() == 0
