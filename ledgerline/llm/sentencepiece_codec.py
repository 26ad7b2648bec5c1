"""SentencePiece encoding and decoding with the tokenizers library.

The model file's protobuf is read field by field; from it the pipeline is
rebuilt: the character map of the normaliser, the metaspace marker, the
unigram scores (or, for a BPE model, the merges that its scores rank), and
byte fallback. The file's bytes travel to the executors by broadcast (a fixed
size, some hundred kB), so no executor needs the path.

When no piece of the model crosses a space, a text's encoding is that of its
space-led parts one after another. Then each distinct part of a batch is
encoded once, in one multithreaded call, decoded once, and checked against the
SentencePiece library once; texts are put together from their parts. Otherwise
whole texts go through the same three calls.

Defined results: null and empty texts give no ids and ``parity`` and
``round_trip`` true; texts of any length are encoded whole; control strings in
a text are ordinary text; repeated rows repeat; an empty table gives none.
"""

from __future__ import annotations

import functools
import os
import struct
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import by_bytes, text_of, tidy

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE_PARTS = 250_000  # distinct parts remembered by a task: memory, not a limit
CALL_PARTS = 32_768    # parts of one call of the library,
GROUP = 64             # and words put into one text of it
THREADS = 2            # of a call: an executor's other cores run other tasks
_PARTS = regex.compile(" *[^ ]+| +")
# Fixed values of the public model format: piece types and model types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(field number, value) of one protobuf message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at:at + size]
            at += size
        else:
            size = {1: 8, 5: 4}[kind]
            yield key >> 3, struct.unpack("<d" if size == 8 else "<f", data[at:at + size])[0]
            at += size


class Model:
    """What the protobuf says: pieces [(text, score, type)] and settings."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        norm: dict = {}
        for number, value in fields(data):
            if number == 1:
                p = dict(fields(value))
                self.pieces.append((p[1].decode("utf-8"), p.get(2, 0.0), p.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
            elif number == 3:
                norm = dict(fields(value))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.charsmap = norm.get(2, b"")
        self.prefix = bool(norm.get(3, 1))
        self.squeeze = bool(norm.get(4, 1))
        self.unk = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        ordinary = (t for t, _, k in self.pieces if k in (NORMAL, USER_DEFINED, UNUSED))
        #: No piece has the marker behind another character, and white space stays as it is.
        self.by_parts = (self.prefix and not self.squeeze and not self.charsmap
                         and all(MARK not in t.lstrip(MARK) for t in ordinary))

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, best score first. A model that
        ranks by score merges the pair whose piece scores highest."""
        ids = {t: i for i, (t, _, k) in enumerate(self.pieces) if k in (NORMAL, USER_DEFINED)}
        found = [(-self.pieces[i][1], ids[t[:k]], ids[t[k:]], t[:k], t[k:])
                 for t, i in ids.items() for k in range(1, len(t)) if t[:k] in ids and t[k:] in ids]
        return [(a, b) for *_, a, b in sorted(found)]


def tokenizer(model: Model, whole: bool):
    """The tokenizers pipeline. ``whole``: for texts; else for parts that
    already begin with their space."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    if model.kind == UNIGRAM:
        core = models.Unigram([(t, s) for t, s, _ in model.pieces], unk_id=model.unk,
                              byte_fallback=model.byte_fallback)
    else:
        core = models.BPE(vocab={t: i for i, (t, *_) in enumerate(model.pieces)}, merges=model.merges(),
                          unk_token=model.pieces[model.unk][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if whole and model.prefix:
        steps.append(normalizers.Prepend(" "))
    out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(),
                                     *([decoders.Strip(" ", 1, 0)] if model.prefix else [])])
    return out


def _keys(text: str) -> list[str]:
    """The space-led parts of a text that is not empty. A word led by its one
    space goes by the word alone; all other parts begin with a space."""
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [p[1:] if len(p) > 1 and p[1] != " " else p for p in _PARTS.findall(" " + text)]


class Codec:
    """Encoder, decoder and parity check of one worker."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = Model(data)
        self.parts = tokenizer(self.model, whole=False) if self.model.by_parts else None
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.leads = np.array([t.startswith(MARK) for t, *_ in self.model.pieces])
        self.known: dict[str, bytes] = {}   # part to its ids, as int32 bytes
        self.unlike: set[str] = set()       # parts whose ids differ from the library's
        self.lossy: set[str] = set()        # parts that decoding does not give back

    @functools.cached_property
    def texts(self):
        return tokenizer(self.model, whole=True)

    def _check(self, tok, units: list[str], plain: list[str]) -> list[tuple[bytes, bool, bool]]:
        """(ids, parity, round trip) of each unit; ``plain``: the texts that the
        SentencePiece library gets for them."""
        ids = [e.ids for e in tok.encode_batch_fast(units, add_special_tokens=False)]
        same = self.reference.encode(plain)
        back = tok.decode_batch(ids, skip_special_tokens=False)
        return [(array("i", i).tobytes(), i == s, b == t) for i, s, b, t in zip(ids, same, back, plain, strict=True)]

    def _check_words(self, words: list[str]) -> list[tuple[str, tuple[bytes, bool, bool]]]:
        """The checks of words led by one space, many words a text: the pieces
        that begin with the marker say where the next word begins. A text that
        is not in order in every way is checked word by word."""
        groups = [words[i: i + GROUP] for i in range(0, len(words), GROUP)]
        texts = [" ".join(g) for g in groups]
        ids = [e.ids for e in self.parts.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        same = self.reference.encode(texts)
        back = self.parts.decode_batch(ids, skip_special_tokens=False)
        out, rest = [], []
        for group, text, mine, theirs, decoded in zip(groups, texts, ids, same, back, strict=True):
            found = np.array(mine, np.int32)
            starts = np.flatnonzero(self.leads[found])
            if len(starts) == len(group) and mine == theirs and decoded == text:
                data, cuts = found.tobytes(), [*(starts * 4).tolist(), 4 * len(found)]
                out += [(w, (data[a:b], True, True)) for w, a, b in zip(group, cuts, cuts[1:], strict=False)]
            else:
                rest += group
        return out + self._check_parts(rest)

    def _check_parts(self, keys: list[str]) -> list[tuple[str, tuple[bytes, bool, bool]]]:
        """The checks of single parts."""
        units = [k if k[0] == " " else " " + k for k in keys]
        out = []
        for key, unit, (ids, same, back) in zip(keys, units, self._check(self.parts, units, [u[1:] for u in units]), strict=True):
            if not unit.strip(" "):  # spaces at a text's end: the library is asked behind a letter
                alone = len(self.reference.encode("a"))
                same = ids == np.array(self.reference.encode("a" + unit)[alone:], np.int32).tobytes()
            out.append((key, (ids, same, back)))
        return out

    def encode(self, texts: list[str]) -> list[tuple[bytes, bool, bool]]:
        """Per text its ids as int32 bytes, parity and round trip."""
        if self.parts is None:
            full = iter(self._check(self.texts, [t for t in texts if t], [t for t in texts if t]))
            return [next(full) if t else (b"", True, True) for t in texts]
        split = [_keys(t) if t else [] for t in texts]
        here = set().union(*split)
        if len(self.known) > CACHE_PARTS:
            self.forget(here)
        known, new = self.known, sorted(here.difference(self.known))
        for at in range(0, len(new), CALL_PARTS):
            some = new[at: at + CALL_PARTS]
            for key, (ids, same, back) in self._check_words([k for k in some if k[0] != " "]) + self._check_parts(
                    [k for k in some if k[0] == " "]):
                known[key] = ids
                if not same:
                    self.unlike.add(key)
                if not back:
                    self.lossy.add(key)
        get = known.__getitem__
        return [(b"".join(map(get, keys)), not self.unlike or self.unlike.isdisjoint(keys),
                 not self.lossy or self.lossy.isdisjoint(keys)) for keys in split]

    def forget(self, but: set[str] = frozenset()) -> None:
        """Drops remembered parts but for the given ones."""
        self.known = {k: self.known[k] for k in but if k in self.known}

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.texts.decode_batch(ids, skip_special_tokens=False)


@functools.lru_cache(maxsize=1)
def _codec(data: bytes) -> Codec:
    """One per worker; building it takes most of a second."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
    return Codec(data)


def encode(df: DataFrame, id_col="doc_id", text_col="text", model_path=MODEL_PATH, batch_bytes=1 << 20) -> DataFrame:
    """One row per input row: id, n_tokens, ids, parity (the SentencePiece
    library gives the same ids) and round_trip (decoding gives the text)."""
    with open(model_path, "rb") as f:
        data = df.sparkSession.sparkContext.broadcast(f.read())
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value)
        for batch in by_bytes(batches, 1, batch_bytes):
            got = codec.encode(batch.column(1).to_pylist())
            sizes = [len(g[0]) // 4 for g in got]
            flat = np.frombuffer(b"".join([g[0] for g in got]), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), ids,
                                   pa.array([g[1] for g in got]), pa.array([g[2] for g in got])],
                                  names=["id", "n_tokens", "ids", "parity", "round_trip"])
        codec.forget()  # a worker lives on for other stages' tasks

    return df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).mapInArrow(
        tidy(run), f"id {id_type}, n_tokens long, ids array<int>, parity boolean, round_trip boolean")


def decode(df: DataFrame, id_col="id", ids_col="ids", model_path=MODEL_PATH) -> DataFrame:
    """One row per input row: id, text. Null ids give an empty text."""
    with open(model_path, "rb") as f:
        data = df.sparkSession.sparkContext.broadcast(f.read())
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(data.value)
        for batch in batches:
            texts = codec.decode([[i for i in x or () if i is not None] for x in batch.column(1).to_pylist()])
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return df.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        run, f"id {id_type}, text string")
