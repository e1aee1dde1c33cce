"""SentencePiece models on the tokenizers library: the model file is parsed here and its rules are rebuilt."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from arcloom.llm.chunk_cache import ChunkCache
from arcloom.llm.text import bounded, small_batches

SPACE = "▁"
RUN = re.compile(" *[^ ]+| +")
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2

#: Distinct chunks whose ids a worker remembers before it starts afresh.
CACHE_CHUNKS = 100_000
#: Threads of one worker's encoder.
THREADS = 2


def _varint(buf: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = buf[i]
        i += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, i
        shift += 7


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """``(field number, value)`` of a protobuf message: int, bytes, or 4 or 8 raw bytes for fixed widths."""
    i = 0
    while i < len(buf):
        key, i = _varint(buf, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(buf, i)
        elif kind == 2:
            n, i = _varint(buf, i)
            value, i = buf[i : i + n], i + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, i = buf[i : i + n], i + n
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


class Model:
    """What a ``.model`` file says: pieces ``(text, score, type)``, the kind of model and the normaliser."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        self.kind, self.byte_fallback, self.whitespace_suffix, self.unk_surface = UNIGRAM, False, False, " ⁇ "
        self.charsmap, self.dummy_prefix, self.squeeze, self.escape = b"", True, True, True
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                self.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                spec = dict(_fields(value))
                self.kind = spec.get(3, UNIGRAM)
                self.byte_fallback = bool(spec.get(35, 0))
                self.whitespace_suffix = bool(spec.get(24, 0))
                self.unk_surface = spec[44].decode() if 44 in spec else self.unk_surface
            elif number == 3:
                spec = dict(_fields(value))
                self.charsmap = spec.get(2, b"")
                self.dummy_prefix, self.squeeze = bool(spec.get(3, 1)), bool(spec.get(4, 1))
                self.escape = bool(spec.get(5, 1))
        if self.kind not in (UNIGRAM, BPE) or self.whitespace_suffix or not self.escape:
            raise ValueError("only unigram and BPE models with a leading space marker are supported")

    @property
    def unk_id(self) -> int:
        return next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)


def _merges(model: Model) -> list[tuple[str, str]]:
    """Every split of a piece into two known pieces; the better the joined piece's score, the earlier."""
    ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    order = sorted(ids, key=lambda p: (-model.pieces[ids[p]][1], ids[p]))
    return [
        (p[:k], p[k:])
        for p in order
        for k in range(len(p) - 1, 0, -1)
        if p[:k] in ids and p[k:] in ids
    ]


def build(path: str):
    """A `tokenizers.Tokenizer` with the pieces, scores or merges, normaliser and byte fallback of the model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

    with open(path, "rb") as f:
        model = Model(f.read())
    if model.kind == UNIGRAM:
        vocab = [(p, s) for p, s, _ in model.pieces]
        core = models.Unigram(vocab, unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    else:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(
            vocab, _merges(model), unk_token=model.pieces[model.unk_id][0], fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    out.normalizer = normalizers.Sequence(steps)
    ends = [decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []
    out.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse(), *ends])
    own = [p for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        out.add_tokens([AddedToken(p, normalized=False) for p in own])
    return out, model


def separable(model: Model) -> bool:
    """Whether text can be cut before each run of spaces: no piece has a space marker after another character."""
    return not model.charsmap and not model.squeeze and model.dummy_prefix and not any(
        SPACE in p.lstrip(SPACE) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED)
    )


class Codec:
    """Encode and decode with a bounded memory of chunks.

    For a model in which no piece spans a word's end and the next space, a text is cut before each run of spaces
    and equal chunks are encoded once, many in one call; any other model gets whole texts. With ``verify`` each
    new chunk (or text) is also encoded by the sentencepiece library, and those that differ are remembered.
    """

    def __init__(self, path: str, threads: int = THREADS, cache: int = CACHE_CHUNKS, verify: bool = False) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        self.tokenizer, self.model = build(path)
        self.chunked = separable(self.model)
        self.other = None
        if verify:
            import sentencepiece

            self.other = sentencepiece.SentencePieceProcessor(model_file=path)
        self.differ: set[str] = set()
        pieces = self.model.pieces
        self.dtype = np.dtype("<u2" if len(pieces) <= 1 << 16 else "<u4")
        self.opens = np.array([p.startswith(SPACE) for p, _, _ in pieces])
        self.is_byte = np.array([kind == BYTE for _, _, kind in pieces])
        surface = [self._surface(p, kind) for p, _, kind in pieces]
        self.lens = np.array([len(x) for x in surface])
        self.firsts = np.cumsum(self.lens) - self.lens
        self.bytes = np.frombuffer(b"".join(surface), np.uint8)
        self.cache = ChunkCache(self._chunks, cache)
        if self.chunked:  # chunks bring their own first space
            from tokenizers import normalizers

            self.tokenizer.normalizer = normalizers.Replace(" ", SPACE)

    def _surface(self, piece: str, kind: int) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return (self.model.unk_surface if kind == UNKNOWN else piece.replace(SPACE, " ")).encode()

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _check(self, texts: list[str], ids: list[list[int]]) -> list[int]:
        """Indexes of texts (without the dummy space) that the sentencepiece library encodes otherwise."""
        if self.other is None:
            return []
        return [i for i, x in enumerate(self.other.encode(texts, num_threads=1)) if x != ids[i]]

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks given without their first space. Plain ones are joined and cut where a piece opens a word."""
        out: dict[str, bytes] = {}
        plain = [c for c in chunks if c and c[0] != " "]
        odd = [c for c in chunks if not c or c[0] == " "]
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        joined = [" ".join(g) for g in groups]
        encoded = self._whole([" " + j for j in joined])
        wrong = set(self._check(joined, encoded))
        for k, (g, ids) in enumerate(zip(groups, encoded, strict=True)):
            a = np.array(ids, self.dtype)
            cuts = np.flatnonzero(self.opens[a])
            if len(cuts) != len(g):
                raise ValueError("the model's pieces do not separate words")
            for c, x in zip(g, np.split(a, cuts[1:]), strict=True):
                out[c] = x.tobytes()
            if k in wrong:
                self.differ.update(g[i] for i in self._check(g, [np.frombuffer(out[c], self.dtype).tolist() for c in g]))
        for c, ids in zip(odd, self._whole([" " + c for c in odd]), strict=True):
            out[c] = np.array(ids, self.dtype).tobytes()
            # a lone space has no text of its own that could be compared: `encode` compares the text that holds it
            if c and self._check([c], [ids]):
                self.differ.add(c)
        return [out[c] for c in chunks]

    def cut(self, text: str) -> list[str]:
        """The text's chunks without the space that opens each; empty text has none."""
        if not text:
            return []
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if text[0] == " " or text[-1] == " " or "  " in text:
            return [c[1:] for c in RUN.findall(" " + text)]
        return text.split(" ")

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[bool | None]]:
        """Ids of each text, and whether the sentencepiece library agrees (None unless verifying).

        Null and empty texts have no ids.
        """
        texts = [t or "" for t in texts]
        none = self.other is None
        if not self.chunked:
            ids = [x if t else [] for t, x in zip(texts, self._whole(texts), strict=True)]
            bad = set(self._check(texts, ids))
            return [np.array(x, self.dtype) for x in ids], [None if none else i not in bad for i in range(len(ids))]
        parts = [self.cut(t) for t in texts]
        found, at, out, same = self.cache.lookup([c for p in parts for c in p]), 0, [], []
        for t, p in zip(texts, parts, strict=True):
            out.append(np.frombuffer(b"".join(found[at : at + len(p)]), self.dtype))
            same.append(None if none else not self.differ or self.differ.isdisjoint(p))
            if same[-1] and "" in p:  # lone spaces are compared in their text
                same[-1] = not self._check([t], [out[-1].tolist()])
            at += len(p)
        return out, same

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, the space marker as space, bytes as UTF-8, the dummy space taken off."""
        ids = np.asarray(ids, np.int64)
        lens = self.lens[ids]
        first = np.cumsum(lens) - lens
        data = self.bytes[np.arange(int(lens.sum())) + np.repeat(self.firsts[ids] - first, lens)].tobytes()
        if self.model.dummy_prefix and data[:1] == b" " and (not len(ids) or self.opens[ids[0]]):
            data = data[1:]
        try:
            return data.decode()
        except UnicodeDecodeError:  # bytes that are no UTF-8: as the library shows them
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)


_CODECS: dict[tuple[str, bool], Codec] = {}


def codec(path: str, verify: bool = False) -> Codec:
    """One per worker process and model."""
    if (path, verify) not in _CODECS:
        _CODECS[path, verify] = Codec(path, verify=verify)
    return _CODECS[path, verify]


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the column ``ids`` (array of int), replacing a column of that name.

    Null and empty texts get an empty list; a model file is read by path on each executor.
    """
    fields = [f for f in docs.schema.fields if f.name != ids_col]
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{ids_col}` array<int>"

    def run(batches):
        own = codec(model_path)
        for b in small_batches(batches, text_col, 2 << 20):
            ids, _ = own.encode(b.column(text_col).to_pylist())
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate([*ids, np.empty(0, np.uint16)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), lists], names=[*names, ids_col])

    return bounded(docs).select(*[f"`{n}`" for n in names]).mapInArrow(run, schema)


def decode_documents(docs: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids`` in ``decoded``; null ids give null."""
    fields = [f for f in docs.schema.fields if f.name != out_col]
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{out_col}` string"

    def run(batches):
        own = codec(model_path)
        for b in batches:
            for i in range(0, b.num_rows, 256):
                s = b.slice(i, 256)
                ids = s.column(ids_col).to_pylist()
                texts = [None if x is None else own.decode(np.array(x, np.int64)) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [*(s.column(n) for n in names), pa.array(texts, pa.string())], names=[*names, out_col]
                )

    return bounded(docs).select(*[f"`{n}`" for n in names]).mapInArrow(run, schema)


def digest_documents(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", verify: bool = True
) -> DataFrame:
    """``doc_id, n_ids, ids_crc32, n_byte_ids, round_trip, parity`` of every whole text.

    ``ids_crc32`` covers the ids as little-endian unsigned 32-bit integers; ``n_byte_ids`` counts byte-fallback
    pieces; ``round_trip`` says whether decoding the ids gives the text; ``parity`` whether the
    sentencepiece library itself gives the same ids (null unless ``verify``). Null text counts as empty.
    """

    def run(batches):
        own = codec(model_path, verify)
        for b in small_batches(batches, text_col, 2 << 20):
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            ids, same = own.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(id_col).cast(pa.int64()),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    pa.array([int(own.is_byte[x].sum()) for x in ids], pa.int64()),
                    pa.array([t == own.decode(x) for t, x in zip(texts, ids, strict=True)], pa.bool_()),
                    pa.array(same, pa.bool_()),
                ],
                names=["doc_id", "n_ids", "ids_crc32", "n_byte_ids", "round_trip", "parity"],
            )

    return bounded(docs).select(id_col, text_col).mapInArrow(
        run, "doc_id long, n_ids long, ids_crc32 long, n_byte_ids long, round_trip boolean, parity boolean"
    )


def tokenize_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids, n_ids, round_trip``: the ids themselves, and whether decoding them gives the text back.

    Null and empty texts have no ids and come back as empty.
    """

    def run(batches):
        own = codec(model_path)
        for b in small_batches(batches, text_col, 2 << 20):
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            ids, _ = own.encode(texts)
            lens = np.array([len(x) for x in ids], np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)),
                pa.array(np.concatenate([*ids, np.empty(0, own.dtype)]).astype(np.int32)),
            )
            same = pa.array([t == own.decode(x) for t, x in zip(texts, ids, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [b.column(id_col).cast(pa.int64()), lists, pa.array(lens), same], names=["doc_id", "ids", "n_ids", "round_trip"]
            )

    return bounded(docs).select(id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, n_ids long, round_trip boolean")
