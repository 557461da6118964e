"""Pre-tokens of texts for word tokenizers, found with the class of each byte."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from trustlake.llm.chunk_cache import ChunkCache, chunk_array, flattened

#: How a tokenizer whose texts can be cut into chunks normalises and splits them.
NORMALISED = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Classes of bytes: space, letter (with the bytes of longer characters), digit, other.
SPACE, LETTER, DIGIT, OTHER = range(4)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = SPACE
CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
CLASS[48:58] = DIGIT
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that keep a word in one chunk: an apostrophe, and what starts a character that is no Latin letter up to U+027F.
WHOLE = np.zeros(256, bool)
WHOLE[[39, *range(0xC0, 0xC3), *range(0xCA, 256)]] = True
#: A chunk that is one pre-token.
PLAIN = re.compile(rb"(?:[a-z]|\xc3(?![\x97\xb7])[\x80-\xbf]|\xc4(?!\xb0)[\x80-\xbf]|[\xc5-\xc9][\x80-\xbf])+|[0-9]|[\x21-\x26\x28-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+")


def word_chunks(flat: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(chunks, number of chunks of each text) of texts' bytes; white space is in none.

    Words of ASCII and Latin letters are put in lower case and cut where letters, digits and other signs meet; a word
    with an apostrophe, another script, a capital dotted I (two characters in lower case), or what may be a special token
    is one chunk as it stands.
    """
    kind = CLASS[flat]
    inside = kind != SPACE
    begins = np.zeros(len(flat) + 1, bool)
    begins[offsets] = True
    begins = begins[:-1]
    word = inside.copy()
    word[1:] &= ~inside[:-1] | begins[1:]
    stays = WHOLE[flat]
    stays[:-1] |= (flat[:-1] == 60) & (flat[1:] == 124) | (flat[:-1] == 0xC3) & ((flat[1:] == 0x97) | (flat[1:] == 0xB7)) | (flat[:-1] == 0xC4) & (flat[1:] == 0xB0)
    cut = inside & (kind == DIGIT)
    cut[1:] |= inside[1:] & (kind[1:] != kind[:-1])
    low = LOWER[flat]
    accented = np.flatnonzero(flat[:-1] == 0xC3) + 1
    low[accented] |= np.where((flat[accented] < 0x9F) & (flat[accented] != 0x97), 0x20, 0).astype(np.uint8)
    odd = np.flatnonzero(stays)
    if len(odd):
        starts = np.flatnonzero(word)
        own = np.unique(np.searchsorted(starts, odd, "right") - 1)
        ends = np.append(starts, len(flat))
        for a, b in zip(starts[own].tolist(), ends[own + 1].tolist()):
            cut[a:b] = False
            low[a:b] = flat[a:b]
    first = word | cut
    at = np.flatnonzero(first)
    kept = np.cumsum(inside)
    return chunk_array(low[inside], kept[at] - 1), np.diff(np.searchsorted(at, offsets))


def whole_texts(flat: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    return chunk_array(flat, offsets[:-1]), np.ones(len(offsets) - 1, np.int64)


def chunk_cache(tokenizer_path: str) -> tuple[ChunkCache, Callable[[np.ndarray, np.ndarray], tuple[pa.Array, np.ndarray]]]:
    """(cache, how texts become chunks) for a tokenizer file; texts are not cut for tokenizers of other kinds."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path)
    file = json.loads(tok.to_str())
    split = (file["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    ending = file["model"].get("end_of_word_suffix")
    can_cut = file["normalizer"] == NORMALISED and split.get("pattern") == {"Regex": SPLIT} and split.get("behavior") == "Removed" and split.get("invert") is True and bool(ending) and file["model"].get("unk_token") is None
    vocab = tok.get_vocab()
    last = np.zeros(max(vocab.values()) + 1, bool)
    if can_cut:
        last[[i for t, i in vocab.items() if t.endswith(ending)]] = True
        can_cut = all(re.fullmatch(r"<\|[a-z]+\|>", t["content"]) for t in file["added_tokens"])

    def alone(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return flattened([e.ids for e in tok.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)])

    def encode(new: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        flags = np.ones(len(new), bool)
        plain = np.fromiter((PLAIN.fullmatch(c) is not None for c in new), bool, len(new)) if can_cut else np.zeros(len(new), bool)
        if not plain.any():
            return *alone(new), flags
        # Each plain chunk is one pre-token, so its last id is the one that ends a word.
        ids = np.array(tok.encode_batch_fast([b" ".join(c for c, p in zip(new, plain) if p).decode()], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(last[ids]) + 1
        if len(ends) != int(plain.sum()):
            return *alone(new), flags
        sizes = np.zeros(len(new), np.int64)
        sizes[plain] = np.diff(ends, prepend=0)
        if not plain.all():
            others, n = alone([c for c, p in zip(new, plain) if not p])
            sizes[~plain] = n
            both, from_plain = np.zeros(int(sizes.sum()), np.uint32), np.repeat(plain, sizes)
            both[from_plain], both[~from_plain] = ids, others
            ids = both
        return ids, sizes, flags

    return ChunkCache(encode), word_chunks if can_cut else whole_texts
