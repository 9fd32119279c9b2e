"""SentencePiece encoding and decoding on the tokenizers library.

The model file is read by its wire format, and from its pieces, scores and
settings an equal tokenizer is built: normaliser, metaspace marker, unigram
scores or merges in the order of their scores, and byte fallback.

If no piece reaches across a space, which the model's own pieces tell, a text's
tokens are those of its words, each with the spaces before it. Then every
different word of a batch is encoded once, and texts are put together from
these; a text whose words all decode to themselves decodes to itself. Other
models encode whole texts. Tokens and decoded
texts are those of the rebuilt tokenizer. Parity: whatever it encodes is also
encoded by the SentencePiece library and compared; a unit that differs marks its
text. Known to differ are long runs of one sign (such as 30 spaces): several
merges give the same piece, and the libraries choose by position or by rank.

A worker process has one codec, which its tasks share, with a store of words that
is bounded by bytes and, when full, keeps those met in most batches; each task
first gives unused memory back to the system.

Defined results: a null text gives null tokens and a null decoded text, an empty
one no tokens. A text that holds the marker itself decodes to spaces in its
place, as with SentencePiece. Repeated rows get equal tokens. Other columns pass
unchanged; input columns named like a result are replaced.
"""

from __future__ import annotations

import codecs
import ctypes
import hashlib
import os
import re
import struct
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from tallyframe.llm.common import add_columns

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
#: Text of the words that a worker keeps, with an allowance for each word.
CACHE_BYTES, WORD_BYTES = 64 << 20, 220
WORDS_AT_ONCE = 16_384
#: Of either library in each task, which has one core: a second thread adds half to the CPU time of encoding.
THREADS = 1
BATCH_BYTES = 2 << 20
SECTION = 1 << 20
RESULTS = {
    "tokens": "ids array<int>, parity boolean",
    "texts": "ids array<int>, decoded string, parity boolean",
    "digests": "n_tokens bigint, ids_sha256 string, round_trip boolean, parity boolean",
}

# Fixed values of the model format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def wire_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"wire type {kind}")
        size = varint() if kind == 2 else 8 if kind == 1 else 4
        if at + size > len(data):
            raise ValueError("the model file is cut off")
        yield key >> 3, data[at : at + size]
        at += size


class Spec(NamedTuple):
    """What a model file says."""

    pieces: list[tuple[str, float, int]]
    model_type: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    squeeze_spaces: bool
    escape_spaces: bool
    suffix_mark: bool

    @property
    def unknown(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def parse_model(data: bytes) -> Spec:
    pieces, trainer, normaliser = [], {}, {}
    for field, value in wire_fields(data):
        if field == 1:
            piece = dict(wire_fields(value))
            score = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
            pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
        elif field == 2:
            trainer = dict(wire_fields(value))
        elif field == 3:
            normaliser = dict(wire_fields(value))
    return Spec(
        pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), normaliser.get(2, b""), bool(normaliser.get(3, 1)),
        bool(normaliser.get(4, 1)), bool(normaliser.get(5, 1)), bool(trainer.get(24, 0)),
    )


def merges_of(spec: Spec) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, the best score of the product first."""
    number = {p: i for i, (p, _, kind) in enumerate(spec.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece in number:
        for k in range(1, len(piece)):
            left, right = number.get(piece[:k]), number.get(piece[k:])
            if left is not None and right is not None:
                found.append((-spec.pieces[number[piece]][1], left, right))
    return [(spec.pieces[a][0], spec.pieces[b][0]) for _, a, b in sorted(found)]


def build(spec: Spec, prefix: bool) -> Tokenizer:
    """The tokenizer of a model; ``prefix`` says whether it puts the space before a text itself."""
    if spec.model_type == UNIGRAM:
        model = models.Unigram([(p, s) for p, s, _ in spec.pieces], spec.unknown, spec.byte_fallback)
    elif spec.model_type == BPE:
        vocabulary = {p: i for i, (p, _, _) in enumerate(spec.pieces)}
        unknown = spec.pieces[spec.unknown][0]
        model = models.BPE(vocabulary, merges_of(spec), unk_token=unknown, fuse_unk=True, byte_fallback=spec.byte_fallback)
    else:
        raise ValueError(f"models of kind {spec.model_type} have no counterpart")
    tokenizer, steps = Tokenizer(model), []
    if spec.charsmap:
        steps.append(normalizers.Precompiled(spec.charsmap))
    if spec.squeeze_spaces:
        steps += [normalizers.Strip(left=True, right=True), normalizers.Replace(Regex(" {2,}"), " ")]
    if prefix and spec.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if spec.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence(undo + [decoders.Strip(" ", 1, 0)] * spec.dummy_prefix)
    return tokenizer


def splits_at_spaces(spec: Spec) -> bool:
    """Whether the tokens of a text are those of its words, each with the spaces before it."""
    plain = spec.dummy_prefix and not spec.squeeze_spaces and not spec.charsmap and spec.escape_spaces and not spec.suffix_mark
    across = re.compile(f"[^{MARK}]{MARK}")
    return plain and not any(across.search(p) for p, _, kind in spec.pieces if kind in (NORMAL, USER_DEFINED))


def places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of all values of slices, one slice after another."""
    found = np.repeat(starts - (np.cumsum(sizes, dtype=np.int64) - sizes), sizes)
    found += np.arange(len(found))
    return found


def before(values: np.ndarray) -> np.ndarray:
    """The sum of the values before each place, and last that of all."""
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


class Codec:
    """Encoder and decoder of one worker, with a bounded store of words already encoded."""

    def __init__(self, data: bytes):
        self.spec = parse_model(data)
        self.by_words = splits_at_spaces(self.spec)
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))  # read when the library's threads start
        self.tokenizer = build(self.spec, prefix=not self.by_words)  # units come with their spaces
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode()
            for p, _, kind in self.spec.pieces
        ]
        self.bytes_of[self.spec.unknown] = " ⁇ ".encode()
        codecs.register_error("each-byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))
        self.control = frozenset(i for i, (_, _, kind) in enumerate(self.spec.pieces) if kind == CONTROL)
        self.clear()

    def clear(self) -> None:
        self.held = 0
        self.number: dict[str, int] = {}
        self.texts: dict[int, str] = {}  # only of words that decode to something else
        self.flat, self.sizes, self.agree = np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, bool)
        self.met = np.zeros(0, np.int32)

    def forget(self) -> None:
        """Keep the words met in most batches, and in several, up to half of the store's bytes."""
        words = list(self.number)
        held = np.fromiter(map(len, words), np.int64, len(words)) + WORD_BYTES
        order = np.argsort(-self.met, kind="stable")
        kept = np.sort(order[(self.met[order] > 1) & (np.cumsum(held[order]) <= CACHE_BYTES // 2)])
        self.flat = self.flat[places(before(self.sizes)[kept], self.sizes[kept])]
        self.sizes, self.agree, self.met = self.sizes[kept], self.agree[kept], self.met[kept] // 2
        self.held, kept = int(held[kept].sum()), kept.tolist()
        self.number = {words[n]: k for k, n in enumerate(kept)}
        self.texts = {k: self.texts[n] for k, n in enumerate(kept) if n in self.texts}

    def both(self, units: list[str], plain: list[str]) -> tuple[list[list[int]], list[bool]]:
        """Tokens of units, and whether both libraries agree on them."""
        got = [e.ids for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
        wanted = self.reference.encode(plain, num_threads=THREADS)
        if self.by_words:  # a last single space, which SentencePiece alone would take for no text
            wanted = [w if p else [self.reference.piece_to_id(MARK)] for w, p in zip(wanted, plain, strict=True)]
        same = [a == b for a, b in zip(got, wanted, strict=True)]
        return got, same

    def units(self, texts: list[str]) -> tuple[pa.Array, np.ndarray, list[int]]:
        """Words without the space before each, the number of words of each text, and which text that is: evenly spaced ones first."""
        even = [k for k, t in enumerate(texts) if "  " not in f" {t} "]
        odd = [k for k, t in enumerate(texts) if "  " in f" {t} "]
        words = pc.split_pattern(pa.array([texts[k] for k in even], pa.large_string()), " ")
        counts, words = pc.list_value_length(words).to_numpy(), words.flatten()
        if odd:
            found = [re.findall(r" ( *[^ ]+| *)", " " + texts[k]) for k in odd]
            counts = np.concatenate([counts, np.fromiter(map(len, found), np.int64, len(found))])
            words = pa.concat_arrays([words, pa.array(chain.from_iterable(found), pa.large_string())])
        return words, counts, even + odd

    def sections(self, text: str) -> Iterator[str]:
        """Parts of a very long text that have its units between them, about ``SECTION`` characters each."""
        start = 0
        while len(text) - start > SECTION:
            cut = re.compile(f"[^ {MARK}][ {MARK}]").search(text, start + SECTION)
            if not cut:
                break
            yield text[start : cut.start() + 1]
            start = cut.start() + 2  # the space comes back before the next part
        yield text[start:]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bool]]:
        """Tokens of each text, and whether they were found alike by both libraries."""
        return [(ids, same) for ids, same, _ in self.round_trip(texts)]

    def round_trip(self, texts: list[str]) -> list[tuple[np.ndarray, bool, str]]:
        """Tokens of each text, whether they were found alike by both libraries, and the text decoded from the tokens.

        Where tokens are those of words, each different word's are decoded once.
        """
        if not self.by_words:
            ids, same = self.both(texts, texts)
            arrays = [np.array(i, np.int32) for i in ids]
            return list(zip(arrays, same, self.decode_all(arrays), strict=True))
        short = iter(self.encode_words([t.replace(MARK, " ") for t in texts if 0 < len(t) <= SECTION]))
        out = []
        for t in texts:
            if not t:
                out.append((np.zeros(0, np.int32), True, ""))
            elif len(t) <= SECTION:
                out.append(next(short))
            else:
                ids, same, back = zip(*(self.encode_words([part.replace(MARK, " ")])[0] for part in self.sections(t)), strict=True)
                out.append((np.concatenate(ids), all(same), " ".join(back)))
        return out

    def encode_words(self, texts: list[str]) -> list[tuple[np.ndarray, bool, str]]:
        """The same for texts without the marker that follow a space, of whose words only those not met before are encoded and decoded."""
        if self.held > CACHE_BYTES:
            self.forget()
        units, counts, order = self.units(texts)
        units = units.dictionary_encode()
        words, units = units.dictionary.to_pylist(), units.indices.to_numpy()
        fresh = [w for w in words if w not in self.number]
        self.held += sum(map(len, fresh)) + WORD_BYTES * len(fresh)
        self.number.update(zip(fresh, range(len(self.sizes), len(self.sizes) + len(fresh)), strict=True))
        flat, sizes, agree = [self.flat], [self.sizes], [self.agree]
        for start in range(0, len(fresh), WORDS_AT_ONCE):  # the library's results are much larger than the tokens
            some = fresh[start : start + WORDS_AT_ONCE]
            ids, same = self.both([" " + w for w in some], some)
            decoded = self.decode_all(ids)  # without the space before it, as at the start of a text
            self.texts |= {self.number[w]: d for w, d in zip(some, decoded, strict=True) if w != d}
            flat.append(np.fromiter(chain.from_iterable(ids), np.int32))
            sizes.append(np.fromiter(map(len, ids), np.int32, len(ids)))
            agree.append(np.array(same, bool))
        self.flat, self.sizes, self.agree = np.concatenate(flat), np.concatenate(sizes), np.concatenate(agree)
        self.met = np.concatenate([self.met, np.zeros(len(fresh), np.int32)])
        known = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        self.met[known] += 1
        starts, ends, out = before(self.sizes), before(counts), [None] * len(texts)
        other = np.zeros(len(self.sizes), bool)
        other[list(self.texts)] = True
        for k, text in enumerate(order):
            unit = units[ends[k] : ends[k + 1]]
            at, back = known[unit], texts[text]
            if other[at].any():
                back = " ".join(self.texts.get(n, words[u]) for n, u in zip(at.tolist(), unit.tolist(), strict=True))
            out[text] = (self.flat[places(starts[at], self.sizes[at])], bool(self.agree[at].all()), back)
        return out

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_all([ids])[0]

    def decode_all(self, texts: list[np.ndarray] | list[list[int]]) -> list[str]:
        """The text of each list of tokens; control pieces have none, and each byte that is not UTF-8 becomes a replacement character.

        The rebuilt decoder gives up a whole run of byte pieces if a part of it is
        not UTF-8, and does not know SentencePiece's sign for unknown pieces; such
        lists, which no encoding of a text by bytes gives, are put together by bytes.
        """
        plain = [t.tolist() if isinstance(t, np.ndarray) else t for t in texts]
        odd = self.control | {self.spec.unknown}
        found = self.tokenizer.decode_batch(plain, skip_special_tokens=False)
        return [self.by_bytes(t) if "\ufffd" in text or not odd.isdisjoint(t) else text for t, text in zip(plain, found, strict=True)]

    def by_bytes(self, tokens: list[int]) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, tokens))
        first = next((p for p, _, kind in map(self.spec.pieces.__getitem__, tokens) if kind != CONTROL), "")
        if self.spec.dummy_prefix and first.startswith(MARK):
            data = data[1:]
        return data.decode(errors="each-byte")


def give_back() -> None:
    """Return memory that neither Arrow nor the allocator uses to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def codec_of(held: dict) -> Codec:
    """The codec of this worker process; ``held`` is a broadcast dictionary, of which a worker has one copy."""
    give_back()
    if "codec" not in held:
        held["codec"] = Codec(held["model"])
    return held["codec"]


def read_model(path: str) -> bytes:
    """A model's bytes; the driver reads them, and the tasks get them by broadcast."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, model: bytes, keep: list[str], text: str = "text", results: str = "texts") -> DataFrame:
    """The columns ``keep`` with tokens and parity, and with ``texts`` also the text decoded from the tokens.

    With ``digests``, the number of tokens, SHA-256 of the tokens as little-endian
    32-bit numbers, and whether the decoded text equals the given one, instead of
    tokens and decoded text.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"model": model})

    def start():
        codec = codec_of(shared.value)

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            given = batch.column(text).to_pylist()
            found = codec.round_trip([t or "" for t in given])
            ids = [None if t is None else i for t, (i, _, _) in zip(given, found, strict=True)]
            parity = pa.array([None if t is None else same for t, (_, same, _) in zip(given, found, strict=True)], pa.bool_())
            if results == "tokens":
                return [pa.array(ids, pa.list_(pa.int32())), parity]
            decoded = [None if t is None else back for t, (_, _, back) in zip(given, found, strict=True)]
            if results == "texts":
                return [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), parity]
            return [
                pa.array([None if i is None else len(i) for i in ids], pa.int64()),
                pa.array([None if i is None else hashlib.sha256(i.astype("<i4").tobytes()).hexdigest() for i in ids], pa.string()),
                pa.array([None if t is None else t == d for t, d in zip(given, decoded, strict=True)], pa.bool_()),
                parity,
            ]

        return work

    return add_columns(docs, text, keep, RESULTS[results], start, piece_bytes=BATCH_BYTES)


def decode(tokens: DataFrame, model: bytes, keep: list[str], ids: str = "ids") -> DataFrame:
    """The columns ``keep`` with ``decoded``, the text of each array of tokens (null for null)."""
    shared = tokens.sparkSession.sparkContext.broadcast({"model": model})

    def start():
        codec = codec_of(shared.value)

        def work(batch: pa.RecordBatch) -> list[pa.Array]:
            given = [None if i is None else np.array(i, np.int32) for i in batch.column(ids).to_pylist()]
            texts = iter(codec.decode_all([i for i in given if i is not None]))
            return [pa.array([None if i is None else next(texts) for i in given], pa.string())]

        return work

    return add_columns(tokens, ids, keep, "decoded string", start)
