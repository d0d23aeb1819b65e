import hashlib
import json
import random
import struct

import pytest
from cases import documents, empty

from mercato.llm.bpe import Bpe, Encoder, Utf8Machine, decode, encode_documents, id_lists, load_spec, sufficient_lookahead
from mercato.llm.common import held, parts

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    t = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def bpe():
    return Bpe(json.loads(load_spec(public_tokenizers.path("word_bpe_49k.json"))))


def odd_texts():
    rnd = random.Random(1)
    alphabet = "abcdefghijklmnopqrstuvwxyz" * 3 + "ABC'.,;0123 \n\té鉶"
    yield from ("", "a" * 5000, "<|endoftext|>Hi<|startoftext|> x<|endoftext|", "don't I'LL we've ΑΣ ΣΑΣ. İstanbul ẞ ﬁ",
                "é ᅡ가 ", "\x1c\x1d a\x85b​᠎　c", "日本語" * 3000, "😀👍🏽" * 500, "１²½Ⅷ", "th" * 3000 + "e", "!?" * 4000, "﻿x\xad", "b\x0bc\x00d", "𝒜ǅ")
    for _ in range(60):
        yield "".join(rnd.choice(alphabet) for _ in range(rnd.choice([5, 50, 3000])))
    for letters in ("ab", "ethrn", "aeiou"):
        yield "".join(rnd.choice(letters) for _ in range(4000))


def test_ids_become_lists_without_an_object_each():
    texts = [[1, 2, 48894], [], [0]]
    assert id_lists([struct.pack(f"<{len(x)}I", *x) for x in texts]).to_pylist() == texts
    assert id_lists([b"", b""]).to_pylist() == [[], []]


def test_a_worker_keeps_one_thing_and_takes_batches_in_parts():
    import weakref

    import pyarrow as pa

    class Made:
        pass

    vocabulary, model = object(), object()
    first = weakref.ref(held(vocabulary, Made))
    assert held(vocabulary, Made) is first()
    assert held(model, lambda: "model") == "model" and first() is None
    batches = [pa.record_batch({"x": list(range(n))}) for n in (2500, 0, 10)]
    assert [p.num_rows for p in parts(iter(batches))] == [1000, 1000, 500, 10]
    assert [x for p in parts(iter(batches)) for x in p.column(0).to_pylist()] == [*range(2500), *range(10)]


def test_ids_and_text_equal_the_library(library, bpe):
    encoder = Encoder(bpe)
    for text in odd_texts():
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == want
        shown = library.decode(want, skip_special_tokens=False)
        assert decode(bpe, want) == shown
        assert b"".join(p[1] for p in encoder.pieces(text))[1:].decode() == shown


def test_what_an_encoder_remembers_is_bounded_by_its_bytes(library, monkeypatch):
    import tracemalloc

    import mercato.llm.bpe as module

    most = 1 << 20
    for name in ("CHUNK_BYTES", "VERDICT_BYTES"):
        monkeypatch.setattr(module, name, most, raising=False)
    spec = load_spec(public_tokenizers.path("word_bpe_49k.json"))
    encoder, rnd = Encoder(Bpe(json.loads(spec))), random.Random(11)
    text = lambda: " ".join(str(rnd.getrandbits(190)) for _ in range(100))  # noqa: E731  # chunks of 57 characters, each another
    tracemalloc.start()
    try:
        for _ in range(100):
            encoder.encode(text())
        assert tracemalloc.get_traced_memory()[0] < 1.5 * 2 * most
    finally:
        tracemalloc.stop()
    # what is forgotten and found again gives the same ids
    for name in ("CHUNK_BYTES", "VERDICT_BYTES"):
        monkeypatch.setattr(module, name, 4000, raising=False)
    encoder = Encoder(Bpe(json.loads(spec)))
    words = ["theory,", "naïve.", "x", "don't", "日本語", "strength", "!?", "<|endoftext|>"]
    for _ in range(30):
        text = " ".join(rnd.choice([*words, "".join(rnd.choice("etaoinsh") for _ in range(9))]) for _ in range(40))
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text) == want
        assert b"".join(p[1] for p in encoder.pieces(text))[1:].decode() == library.decode(want, skip_special_tokens=False)


def test_query_rows(spark, library):
    got = encode_documents(documents(spark), public_tokenizers.path("word_bpe_49k.json"), with_ids=True).collect()
    texts = [r["text"] for r in documents(spark).collect()]
    assert len(got) == len(texts)
    want = []
    for r in documents(spark).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(shown.encode()).hexdigest(), ids))
    key = lambda x: (x[0] is None, x[0] or 0, x[2])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert encode_documents(empty(spark), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_lookahead_is_sufficient_and_memory_constant(bpe):
    """Whatever follows, a token that the transducer lets go is the token of the whole word."""
    rnd = random.Random(3)
    bpe_block = bpe.longest + bpe.lookahead + 256
    for _ in range(30):
        word = "".join(rnd.choice("theringsaou") for _ in range(3 * bpe_block))
        assert list(bpe.transduce(word)) == bpe.merge([*word[:-1], word[-1] + bpe.suffix])

    class Counting:
        held = 0

        def __iter__(self):
            for _ in range(200_000):
                self.held += 1
                yield rnd.choice("ehtaor")

    source, behind, out = Counting(), 0, 0
    for t in bpe.transduce(source):
        out += bpe.length(t)
        behind = max(behind, source.held - out)
    assert out == 200_000 and behind <= bpe_block


def test_reach_on_random_merge_lists():
    """reach() of toy merge lists against all continuations: a token that far from the end never changes."""
    rnd = random.Random(5)
    for _ in range(40):
        vocab, merges = ["a", "b", "c"], []
        for _ in range(rnd.randint(2, 7)):
            pair = rnd.choice(vocab), rnd.choice(vocab)
            if len(pair[0] + pair[1]) <= 5 and pair[0] + pair[1] not in vocab:
                merges.append(pair)
                vocab.append(pair[0] + pair[1])
        spec = {"model": {"vocab": {v: i for i, v in enumerate(vocab)}, "merges": [list(m) for m in merges]}}
        toy = Bpe(spec)
        assert toy.reach == sufficient_lookahead(merges, len)
        for _ in range(60):
            word = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
            assert toy.window(word, True) == toy.merge(list(word))
            more = word + "".join(rnd.choice("abc") for _ in range(6))
            short, long, at = toy.merge(list(word)), toy.merge(list(more)), 0
            for k, t in enumerate(short):
                at += len(t)
                if at + toy.reach.get(t, 0) > len(word):
                    break
                assert long[k] == t


def test_stream_equals_whole(bpe):
    encoder = Encoder(bpe)
    rnd = random.Random(9)
    text = "".join(rnd.choice("abc de.'fé\n") for _ in range(5000)) + "z" * 70_000 + "." * 70_000 + " end"
    parts, at = [], 0
    while at < len(text):
        n = rnd.randint(1, 9000)
        parts.append(text[at:at + n])
        at += n
    assert list(encoder.stream(parts)) == encoder.encode(text)


def test_bytes_become_text_one_id_at_a_time():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    bpe = Bpe(json.loads(load_spec(path)))
    rnd = random.Random(2)
    for text in ("日本語 naïve 😀👍🏽", "plain"):
        ids = library.encode(text, add_special_tokens=False).ids
        assert decode(bpe, ids, byte_level=True) == text
    for _ in range(200):  # any ids, also those that break code points
        ids = [rnd.randrange(50_000) for _ in range(8)]
        machine = Utf8Machine(bpe)
        assert "".join(machine.feed(i) for i in ids) + machine.finish() == library.decode(ids, skip_special_tokens=False)


def test_a_vocabulary_too_large_to_broadcast_is_refused(tmp_path, monkeypatch):
    import mercato.llm.bpe as module

    (tmp_path / "v.json").write_text("{}" * 50)
    monkeypatch.setattr(module, "MAX_VOCAB_BYTES", 10)
    with pytest.raises(ValueError, match="too large"):
        load_spec(str(tmp_path / "v.json"))
