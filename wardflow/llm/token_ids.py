"""Token ids of whole texts by a public tokenizer file.

The tokenizer of ``word_bpe_49k.json`` drops white space and never joins
across it, so a text's ids are those of its ASCII-space-separated chunks in
turn.  Chunks repeat, so a batch of texts is split and its distinct chunks numbered
in Arrow; each worker keeps the ids of the chunks it has met, as
little-endian unsigned 32-bit bytes, in a cache of bounded size, and the
texts' ids are joined by chunk number.

Chunks of plain Latin characters that are not in the cache take a shorter
way: their pieces go through the same merges in another byte-pair encoder,
with the end-of-word mark written as a space.  All other chunks go through
the tokenizer itself.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks a worker keeps at most, and the longest chunk worth keeping (bytes).
CACHE_CHUNKS = 400_000
CACHE_CHUNK_BYTES = 40
#: Bytes of text that are split at a time (a longer text by itself).
SPLIT_BYTES = 4 << 20
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Characters whose lower case and class are the same in every Unicode version, and that no normal form changes.
PLAIN = r"[!-~¡-įı-ɏ]+"
END_OF_WORD = "</w>"


def default_path() -> str:
    """Where the default tokenizer file lies on this machine."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable
    Latin-1 characters stand for themselves, the others follow from U+0100."""
    own = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ChunkTokenizer:
    """Ids of texts from a tokenizer's JSON text."""

    def __init__(self, json_text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core already
        import regex
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(json_text)
        self.cache: dict[bytes, bytes] = {}
        spec = json.loads(json_text)
        letters, ranks = byte_letters(), {}
        for token, i in spec["model"]["vocab"].items():
            end = token.endswith(END_OF_WORD)
            body = token[:-len(END_OF_WORD)] if end else token
            ranks[bytes(letters[c] for c in body) + b" " * end] = i
        self.merges = tiktoken.Encoding("merges", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.plain = regex.compile(PLAIN).fullmatch
        self.pieces = regex.compile(PIECES).findall
        self.plain_lines = regex.compile(f"(?:{PLAIN}|\n)+").fullmatch
        self.ends_word = np.zeros(max(ranks.values()) + 1, bool)
        self.ends_word[[i for token, i in ranks.items() if token.endswith(b" ")]] = True

    def _encode(self, chunk: str) -> bytes:
        if chunk.isalpha() and self.plain(chunk):
            ids = self.merges.encode_ordinary(chunk.lower() + " ")
        elif self.plain(chunk) and not any(s in chunk for s in self.special):
            ids = self.merges.encode_ordinary(" ".join(self.pieces(chunk.lower())) + " ")
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_all(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of every chunk; plain chunks in one call of the encoder, whose
        ids are dealt out by the tokens that end a piece."""
        lines = b"\n".join(chunks).decode()
        if not self.plain_lines(lines) or any(s in lines for s in self.special):
            if len(chunks) < 2:
                return [self._encode(c.decode()) for c in chunks]
            return [i for half in (chunks[:len(chunks) // 2], chunks[len(chunks) // 2:]) for i in self._encode_all(half)]
        parts = [c if c.isalpha() else self.pieces(c) for c in lines.lower().split("\n")]
        n_pieces = [1 if isinstance(c, str) else len(c) for c in parts]
        text = " ".join([c if isinstance(c, str) else " ".join(c) for c in parts])
        ids = np.array(self.merges.encode_ordinary(text + " "), "<u4")
        ends = (4 * (np.flatnonzero(self.ends_word[ids])[np.cumsum(n_pieces) - 1] + 1)).tolist()
        data = ids.tobytes()
        return [data[a:b] for a, b in zip([0] + ends, ends)]

    def ids(self, text: str | None) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        chunks = (text or "").encode().split()
        cache = self.cache
        try:
            return b"".join([cache[c] for c in chunks])
        except KeyError:
            pass
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        out = []
        for c in chunks:
            i = cache.get(c)
            if i is None:
                i = self._encode(c.decode())
                if len(c) <= CACHE_CHUNK_BYTES:
                    cache[c] = i
            out.append(i)
        return b"".join(out)


    def batch_ids(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of every text of an Arrow column of strings, in turn."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + SPLIT_BYTES, "right")))
            yield from self._some_ids(texts.slice(at, upto - at))
            at = upto

    def _some_ids(self, texts: pa.Array) -> Iterator[bytes]:
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        bounds = lists.offsets.to_numpy().tolist()
        numbered = pc.dictionary_encode(lists.values)
        cache = self.cache
        if len(cache) > CACHE_CHUNKS:
            cache.clear()
        chunks = pc.cast(numbered.dictionary, pa.binary()).to_numpy(zero_copy_only=False).tolist()
        known = [cache.get(c) if c else b"" for c in chunks]  # Arrow splits off empty ends
        new = [k for k, i in enumerate(known) if i is None]
        for k, i in zip(new, self._encode_all([chunks[k] for k in new]) if new else []):
            known[k] = i
            if len(chunks[k]) <= CACHE_CHUNK_BYTES:
                cache[chunks[k]] = i
        get, codes = known.__getitem__, numbered.indices.to_numpy().tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            yield b"".join(map(get, codes[a:b]))


def worker_tokenizer(json_text: str) -> ChunkTokenizer:
    """The worker process's tokenizer for a JSON text; it and its cache stay
    between tasks, outside the modules that travel with them."""
    kept = sys.modules.setdefault("_chunk_tokenizers", types.ModuleType("_chunk_tokenizers")).__dict__
    key = str(hash(json_text))
    if key not in kept:
        kept[key] = ChunkTokenizer(json_text)
    return kept[key]
