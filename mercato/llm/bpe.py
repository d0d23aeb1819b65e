"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

**Encoding.**  A merge list is applied to a stream of symbols without
holding the whole word.  Between two merges that share a symbol the one of
lower rank wins, so the fate of a token depends on what follows it only
through a chain of merges of falling rank.  ``sufficient_lookahead`` walks
that chain for every token in one pass over the merge list: with ``reach(t, r)``
the number of symbols behind a token ``t`` that decide whether it stands
once all merges ranked below ``r`` were applied,

    reach(t, r) = max(formed(t), |z| + reach(z, rank(t z)) for merges (t, z) ranked below r)
    formed(l r) = reach(r, rank(l r)),  formed(single symbol) = 0.

A token of a window that ends at least ``reach(t, infinity)`` symbols before
the end of the window is the token of the whole stream, whatever comes
later; it is emitted and dropped.  The window therefore never exceeds the
longest token plus the largest reach plus one read block: memory is
constant however long a word is.

**Decoding.**  ``Utf8Machine`` turns the bytes of byte-level tokens into text
incrementally, holding back at most the three bytes of an unfinished code
point.  A vocabulary without a decoder rule is decoded as its token strings
joined by one space, which is what the tokenizers library does then.

The vocabulary file is a parameter; it is read on the driver and broadcast
(``MAX_VOCAB_BYTES`` bounds it).
"""

from __future__ import annotations

import codecs
import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import held, parts

#: Largest vocabulary file that is broadcast to the executors.
MAX_VOCAB_BYTES = 64 << 20
#: Bytes that encoded chunks, and verdicts on neighbouring tokens, may take in a Python worker, about.
CHUNK_BYTES, VERDICT_BYTES = 45 << 20, 30 << 20
#: What an entry takes, about: for a chunk besides its characters and ids, for a verdict in all.
CHUNK_ENTRY, VERDICT_ENTRY = 140, 90
#: Symbols read before the stable tokens of a long word are emitted.
BLOCK = 256

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def sufficient_lookahead(merges: Iterable[tuple[str, str]], length) -> dict[str, int]:
    """``reach(t, infinity)`` of every token that can be extended or was merged (others: 0)."""
    formed: dict[str, int] = {}
    reach: dict[str, int] = {}  # over the merges seen so far, that is, of lower rank
    for left, right in merges:
        ahead = max(formed.get(right, 0), reach.get(right, 0))
        formed.setdefault(left + right, ahead)
        reach[left] = max(reach.get(left, 0), length(right) + ahead)
    return {t: max(formed.get(t, 0), reach.get(t, 0)) for t in {*formed, *reach}}


class Recent:
    """What was worked out last, by key, in bounded memory: entries used since the last turn, and the older ones, which go at the next.

    A turn comes when the newer entries take half of the memory.  ``new`` stays the same object.
    """

    def __init__(self, most: int):
        self.most = most
        self.new: dict = {}
        self.old: dict = {}
        self.size = 0

    def aged(self, key, entry: int):
        """An older entry, which becomes a newer one; None if there is none."""
        found = self.old.get(key)
        return None if found is None else self.put(key, found, entry)

    def put(self, key, value, entry: int):
        if self.size + entry > self.most // 2:
            self.old = self.new.copy()
            self.new.clear()
            self.size = 0
        self.size += entry
        self.new[key] = value
        return value


class Bpe:
    """A merge list with an optional end-of-word suffix, and its transducer."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        own = {t: t for t in self.vocab}.get  # the same string is kept once
        pairs = [tuple([own(t, t) for t in (m.split(" ") if isinstance(m, str) else m)]) for m in model["merges"]]
        self.ranks = {p: k for k, p in reversed(list(enumerate(pairs)))}
        self.reach = sufficient_lookahead(pairs, self.length)
        self.lookahead = max(self.reach.values(), default=0)
        self.longest = max(map(self.length, self.vocab), default=1)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.byte = byte_symbols()
        #: Whether the merges keep two tokens side by side, by one number for both (see ``window``).
        self.stands = Recent(VERDICT_BYTES)
        #: By the first three symbols: the longest token that begins so.
        self.reaches: dict[str, int] = {}
        for t in self.vocab:
            n = self.length(t)
            if n > 2:
                self.reaches[t[:3]] = max(self.reaches.get(t[:3], 0), n)

    def length(self, token: str) -> int:
        """Symbols of a token; the end-of-word mark belongs to the last one."""
        if self.suffix and token.endswith(self.suffix) and token != self.suffix:
            return len(token) - len(self.suffix)
        return len(token)

    def merge(self, symbols: list[str]) -> list[str]:
        """All merges applied to a window, lowest rank first, leftmost first."""
        get, top = self.ranks.get, 1 << 60
        while len(symbols) > 1:
            ranks = [get(p, top) for p in zip(symbols, symbols[1:])]
            best = min(ranks)
            if best == top:
                break
            at = ranks.index(best)
            left, right = symbols[at], symbols[at + 1]
            out = symbols[:at]
            n = len(symbols)
            while at < n:
                if symbols[at] == left and at + 1 < n and symbols[at + 1] == right:
                    out.append(left + right)
                    at += 2
                else:
                    out.append(symbols[at])
                    at += 1
            symbols = out
        return symbols

    def adjacent(self, left: str, right: str, pair: int) -> bool:
        """Whether the merges keep ``left`` and ``right`` (``""``: none) as they are side by side; remembered by ``pair``."""
        found = self.stands.new.get(pair)
        if found is None:
            found = self.stands.aged(pair, VERDICT_ENTRY)
        if found is None:
            want = [t for t in (left, right) if t]
            found = self.stands.put(pair, self.merge([s for t in want for s in self.symbols(t)]) == want, VERDICT_ENTRY)
        return found

    def symbols(self, token: str) -> list[str]:
        n = self.length(token)
        return [*token[: n - 1], token[n - 1:]]

    def window(self, text: str, last: bool) -> list[str]:
        """The tokens that ``merge`` makes of a window, found from left to right.

        Tokens stand in the result if and only if every two neighbours keep
        standing when merged alone, so the longest token is tried first
        and shorter ones, or a step back, when its neighbour forbids it.
        ``last``: the word ends with the window.
        """
        out: list[str] = []
        sizes: list[int] = []
        dead: set[int] = set()
        n, at, vocab, stands, reaches, end_mark = len(text), 0, self.vocab, self.stands.new, self.reaches, self.suffix if last else ""
        size = min(reaches.get(text[:3], 2), n)
        while at < n:
            before = out[-1] if out else ""
            first = vocab[before] + 1 << 32 if out else 0
            while size:
                end = at + size
                if end not in dead:
                    piece = text[at:end] + end_mark if end == n else text[at:end]
                    if piece in vocab:
                        pair = first | vocab[piece]
                        if pair in stands and stands[pair] or self.adjacent(before, piece, pair):
                            break
                size -= 1
            if size:
                out.append(piece)
                sizes.append(size)
                at = end
                size = reaches.get(text[at:at + 3], 2)
                if size > n - at:
                    size = n - at
            elif out:
                dead.add(at)
                out.pop()
                size = sizes.pop()
                at -= size
                size -= 1
            else:  # a symbol that the vocabulary lacks
                return self.merge([*text[: n - 1], text[n - 1:] + end_mark])
        return out

    def transduce(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of a stream of symbols, each emitted once nothing that follows can change it."""
        window = ""
        full = self.longest + self.lookahead + BLOCK
        for s in symbols:
            window += s
            if len(window) >= full:
                end, at = len(window) - 1, 0  # whether the newest symbol is the last is not known yet
                for t in self.window(window[:end], False):
                    if at + self.length(t) + self.reach.get(t, 0) > end:
                        break
                    yield t
                    at += self.length(t)
                window = window[at:]
        if window:
            yield from self.window(window, True)

    def word(self, word: str) -> Iterable[str]:
        """Tokens of a word; those that the vocabulary lacks are left out, as by a model without an unknown token."""
        text = word if word.isascii() and word.isprintable() else "".join([self.byte[b] for b in word.encode()])
        tokens = self.window(text, True) if len(text) <= self.longest + self.lookahead else self.transduce(text)
        return [t for t in tokens if t in self.vocab]

    def encode_word(self, word: str) -> list[int]:
        return [self.vocab[t] for t in self.word(word)]


# Fixed value: how the vocabulary's text is cut into words (as its file states).
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: What str.split() takes for white space and the vocabulary's rule does not.
ODD_SPACES = "\x1c\x1d\x1e\x1f"


def normalised(text: str) -> str:
    """NFC and lower case, one code point at a time (no final sigma)."""
    if text.isascii():
        return text.lower()
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class Encoder:
    """Texts to ids; remembers encoded chunks (runs without white space) in bounded memory."""

    def __init__(self, bpe: Bpe):
        self.bpe = bpe
        self.special = regex.compile("|".join(map(regex.escape, sorted(bpe.special, key=len, reverse=True)))) if bpe.special else None
        #: By the chunk, what ``chunk`` gives.
        self.known = Recent(CHUNK_BYTES)
        self.token = {i: f" {t}".encode() for i, t in bpe.tokens.items()}

    def chunk(self, chunk: str) -> bytes:
        """The chunk's ids as little-endian 32-bit integers."""
        body, known = chunk[:-1], self.known.new.get
        if chunk[-1] in ".," and body.isalpha():  # the stop is a word of its own
            return (known(body) or self.chunk(body)) + (known(chunk[-1]) or self.chunk(chunk[-1]))
        older = self.known.old.get(chunk)
        if older is not None:
            return self.remembered(chunk, older)
        tokens = self.bpe.word(chunk) if chunk.isalpha() else [t for w in WORD.findall(chunk) for t in self.bpe.word(w)]
        vocab = self.bpe.vocab
        found = struct.pack(f"<{len(tokens)}I", *[vocab[t] for t in tokens])
        return self.remembered(chunk, found) if len(chunk) <= 64 else found

    def remembered(self, chunk: str, found: bytes) -> bytes:
        return self.known.put(chunk, found, CHUNK_ENTRY + (1 if chunk.isascii() else 4) * len(chunk) + len(found))

    def shown(self, ids: bytes) -> bytes:
        """The decoded text of encoded ids, a space before each token."""
        token = self.token
        return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def plain(self, text: str) -> Iterator[bytes]:
        """The ids of each chunk of a text without special tokens."""
        text = normalised(text)
        chunks = regex.findall(r"[^\s]+", text) if any(c in text for c in ODD_SPACES) else text.split()
        known, chunk = self.known.new.get, self.chunk
        for c in chunks:
            yield known(c) or chunk(c)

    def encoded(self, text: str) -> Iterator[bytes]:
        """The ids of a text, piece by piece; special tokens are found in it as it stands."""
        at = 0
        if self.special is not None and any(s in text for s in self.bpe.special):
            for m in self.special.finditer(text):
                yield from self.plain(text[at:m.start()])
                yield struct.pack("<I", self.bpe.special[m[0]])
                at = m.end()
        yield from self.plain(text[at:] if at else text)

    def pieces(self, text: str) -> Iterator[tuple[bytes, bytes]]:
        """The ids of each piece of a text, and its decoded text."""
        for ids in self.encoded(text):
            yield ids, self.shown(ids)

    def encode(self, text: str | None) -> list[int]:
        data = b"".join(self.encoded(text or ""))
        return list(struct.unpack(f"<{len(data) // 4}I", data))

    def stream(self, parts: Iterable[str]) -> Iterator[int]:
        """Ids of a text that arrives in parts, as ``encode`` gives them for the joined text.

        Held back is what follows the last white space; a longer run without
        any is cut where words of different kinds meet, or else fed to the
        transducer, so that memory stays constant.  Special tokens are not
        looked for in a stream.
        """
        held = ""
        for part in parts:
            held += part
            cut = max(held.rfind(c) for c in " \n\t\r") + 1
            if cut:
                for ids in self.plain(held[:cut]):
                    yield from struct.unpack(f"<{len(ids) // 4}I", ids)
                held = held[cut:]
            if len(held) > 1 << 16:
                held = yield from self._long_run(held)
        for ids in self.plain(held):
            yield from struct.unpack(f"<{len(ids) // 4}I", ids)

    def _long_run(self, held: str):
        """Encodes all words of a long run but the last; of a single long word the stable tokens."""
        words = list(WORD.finditer(normalised(held)))
        if len(words) > 1:
            text = normalised(held)
            for w in words[:-1]:
                yield from self.bpe.encode_word(w[0])
            return text[words[-1].start():]
        return held


def decode(bpe: Bpe, ids: Iterable[int], byte_level: bool = False) -> str:
    """Text of ids: token strings joined by a space, or, for byte-level vocabularies, their bytes as text."""
    if not byte_level:
        return " ".join(bpe.tokens[i] for i in ids if i in bpe.tokens)
    machine = Utf8Machine(bpe)
    return "".join(machine.feed(i) for i in ids) + machine.finish()


class Utf8Machine:
    """Byte-level tokens to text, one id at a time; holds back unfinished code points."""

    def __init__(self, bpe: Bpe):
        self.tokens, self.suffix = bpe.tokens, bpe.suffix
        self.value = {s: b for b, s in enumerate(bpe.byte)}
        self.state = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, i: int) -> str:
        token = self.tokens.get(i, "")
        end = " " if self.suffix and token.endswith(self.suffix) else ""
        body = token[: -len(self.suffix)] if end else token
        if all(c in self.value for c in body):
            return self.state.decode(bytes(self.value[c] for c in body)) + (self.state.decode(b"", True) + end if end else "")
        return self.state.decode(b"", True) + body + end

    def finish(self) -> str:
        return self.state.decode(b"", True)


def load_spec(path: str) -> str:
    """The vocabulary file's JSON, at most ``MAX_VOCAB_BYTES`` long."""
    with open(path, encoding="utf-8") as f:
        data = f.read(MAX_VOCAB_BYTES + 1)
    if len(data) > MAX_VOCAB_BYTES:
        raise ValueError(f"{path} exceeds {MAX_VOCAB_BYTES} bytes; it is too large to broadcast")
    return data


def encoder_of(spec) -> Encoder:
    """One encoder per Python worker and broadcast vocabulary."""
    return held(spec, lambda: Encoder(Bpe(json.loads(spec.value))))


def id_lists(encoded: list[bytes]) -> pa.ListArray:
    """Encoded texts as lists of ids, without a Python object for each id."""
    ends = np.cumsum([0, *[len(ids) // 4 for ids in encoded]])
    ids = np.frombuffer(b"".join(encoded), "<i4").astype(np.int32, copy=False)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def encode_documents(docs: DataFrame, vocab_path: str, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes every whole text.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``, an
    array, with ``with_ids``) for every row, in a single pass without a
    shuffle.  Null and empty texts have no tokens; repeated rows each give a
    row; a null id stays null; other columns are not read, whatever their names.
    """
    spec = docs.sparkSession.sparkContext.broadcast(load_spec(vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(spec)
        for batch in parts(batches):
            out: list[list] = [[], [], [], []]
            for text in batch.column(1):
                ids = b"".join(encoder.encoded(text.as_py() or ""))
                shown = encoder.shown(ids)[1:]
                out[0].append(len(ids) // 4)
                out[1].append(hashlib.sha256(ids).hexdigest())
                out[2].append(hashlib.sha256(shown).hexdigest())
                if with_ids:
                    out[3].append(ids)
            columns = [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(id_lists(out[3]))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(run, RESULT + (", ids array<int>" if with_ids else ""))
