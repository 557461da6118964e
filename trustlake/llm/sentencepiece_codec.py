"""SentencePiece models run by the tokenizers library.

The model file is a protocol buffer; it is read here field by field and rebuilt as normaliser, metaspace marker,
scored pieces (unigram) or merges (BPE) and byte fallback. What is encoded is also encoded by the sentencepiece library:
each new chunk where a model's chunks can be encoded alone, each whole text otherwise. A document is in parity if all agree.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustlake.llm.chunk_cache import ChunkCache, chunk_array, flattened
from trustlake.llm.common import joined_bytes, map_arrow, text_or_empty

MARK = "▁"
#: Kinds of pieces in the model file: normal, unknown, control, user defined, byte.
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: int | bytes = varint()
        else:
            n = {1: 8, 5: 4}.get(kind) or varint()
            value = data[at : at + n]
            at += n
        yield key >> 3, value


def parse_model(data: bytes) -> dict:
    """The parts of a SentencePiece model that encoding needs."""
    pieces: list[tuple[str, float, int]] = []
    trainer: dict = {}
    norm: dict = {}
    for number, value in fields(data):
        if number == 1:
            f = dict(fields(value))
            pieces.append((f.get(1, b"").decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            norm = dict(fields(value))
    return {
        "pieces": pieces,
        "kind": {1: "unigram", 2: "bpe"}[trainer.get(3, 1)],
        "byte_fallback": bool(trainer.get(35, 0)),
        "unk": next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0),
        "charsmap": norm.get(2, b""),
        "dummy_prefix": bool(norm.get(3, 1)),
        "squeeze": bool(norm.get(4, 1)),
        "escape": bool(norm.get(5, 1)),
    }


def rebuilt(model: dict):
    """The tokenizers-library tokenizer of a parsed model; its input is normalised and has the marker already."""
    from tokenizers import AddedToken, Tokenizer, decoders, models

    pieces = model["pieces"]
    vocab = {p: i for i, (p, _, _) in enumerate(pieces)}
    if model["kind"] == "unigram":
        tok = Tokenizer(models.Unigram([(p, s) for p, s, _ in pieces], model["unk"], model["byte_fallback"]))
    else:
        # A piece may come of any split of it into two pieces; the merge with the best scored result goes first.
        usable = {p for p, _, kind in pieces if kind in (NORMAL, USER)}
        merges = [(i, p[:k], p[k:]) for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL and len(p) > 1 for k in range(1, len(p)) if p[:k] in usable and p[k:] in usable]
        merges.sort(key=lambda m: (-pieces[m[0]][1], vocab[m[1]], vocab[m[2]]))
        tok = Tokenizer(models.BPE(vocab, [m[1:] for m in merges], unk_token=pieces[model["unk"]][0], fuse_unk=True, byte_fallback=model["byte_fallback"]))
    user = [AddedToken(p, normalized=False) for p, _, kind in pieces if kind == USER]
    if user:
        tok.add_tokens(user)
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tok.decoder = decoders.Sequence(steps + [decoders.Strip(" ", 1, 0)] * model["dummy_prefix"])
    return tok


class Codec:
    """Encodes and decodes texts as a model file's bytes say."""

    def __init__(self, data: bytes):
        import sentencepiece
        from tokenizers import normalizers

        self.model = m = parse_model(data)
        self.tok = rebuilt(m)
        self.own = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.charsmap = normalizers.Precompiled(m["charsmap"]) if m["charsmap"] else None
        # Chunks can be encoded alone if only spaces change before encoding and no piece holds the marker behind another character.
        plain = m["escape"] and m["dummy_prefix"] and not m["charsmap"] and not m["squeeze"]
        self.alone = plain and not any(MARK in p.lstrip(MARK) for p, _, kind in m["pieces"] if kind in (NORMAL, USER))
        self.cache = ChunkCache(self._encode)

    def normalise(self, text: str) -> str:
        if self.charsmap:
            text = self.charsmap.normalize_str(text)
        if self.model["squeeze"]:
            text = " ".join(x for x in text.split(" ") if x)
        if text and self.model["dummy_prefix"]:
            text = " " + text
        return text.replace(" ", MARK) if self.model["escape"] else text

    def _encode(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of new chunks, and whether the library gives the same; a chunk begins with a space, which the library puts there itself."""
        chunks = [c.decode() for c in new]
        mine = [e.ids for e in self.tok.encode_batch_fast([c.replace(" ", MARK) for c in chunks], add_special_tokens=False)]
        theirs = self.own.encode([c[1:] for c in chunks], num_threads=1)
        lone = [self.own.piece_to_id(MARK)]
        same = np.fromiter((i == (j if c != " " else lone) for c, i, j in zip(chunks, mine, theirs)), bool, len(new))
        return *flattened(mine), same

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, the texts' offsets in them, whether the sentencepiece library gives the same ids for a text)."""
        if self.alone:
            flat, offsets = joined_bytes(texts)
            return self.cache.ids(*marked_chunks(flat, offsets))
        whole = texts.to_pylist()
        mine = [e.ids for e in self.tok.encode_batch_fast([self.normalise(t) for t in whole], add_special_tokens=False)]
        same = [i == j for i, j in zip(mine, self.own.encode(whole, num_threads=1))]
        ids, sizes = flattened(mine)
        return ids, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), np.array(same, bool)

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tok.decode_batch(ids, skip_special_tokens=False)


def marked_chunks(flat: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(chunks, number of chunks of each text): each text that is not empty gets a space in front and is cut before each run of spaces."""
    filled = np.diff(offsets) > 0
    spaced = np.insert(flat, offsets[:-1][filled], 32)
    ends = np.concatenate([[0], np.cumsum(np.diff(offsets) + filled)])
    first = spaced == 32
    first[1:] &= spaced[:-1] != 32
    first[ends[:-1][filled]] = True
    at = np.flatnonzero(first)
    return chunk_array(spaced, at), np.diff(np.searchsorted(at, ends))


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        with open(path, "rb") as f:
            _CODECS[path] = Codec(f.read())
    return _CODECS[path]


def encode_documents(docs: DataFrame, model_path: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_ok, parity and, with ``keep_ids``, ids of each document's whole text.

    ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers. ``decoded_ok`` tells whether decoding the
    ids gives the text again, as far as the model's normaliser keeps it; ``parity`` whether the sentencepiece library
    gives the same ids for every chunk of it, or for the whole text. A null text counts as empty: no ids, both true. Repeated rows stay,
    a null doc_id is kept, an empty table gives no rows, and columns other than doc_id and text are not read. The
    library's own threads encode a batch; a text that repeats a chunk looks it up.
    """

    def run(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        texts = part.column("text").to_pylist()
        ids, at, same = c.encode(part.column("text"))
        own = [ids[a:b] for a, b in zip(at[:-1], at[1:])]
        back = c.decode([x.tolist() for x in own])
        lead = 1 if c.model["dummy_prefix"] else 0
        want = [c.normalise(t)[lead:].replace(MARK, " ") for t in texts]
        out = {
            "doc_id": part.column("doc_id"),
            "n_tokens": pa.array(np.diff(at), pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in own], pa.int64()),
            "decoded_ok": pa.array([a == b for a, b in zip(back, want)], pa.bool_()),
            "parity": pa.array(same),
        }
        if keep_ids:
            out["ids"] = pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, n_tokens long, ids_crc32 long, decoded_ok boolean, parity boolean" + ", ids array<int>" * keep_ids
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")), run, schema, "text")
