"""Token ids of whole texts by a fixed public tokenizer, with a bounded cache.

A byte-level BPE pre-tokenizer binds a single space between two other characters
to what follows it, and parts a single line break from both, so what stands between
them is encoded on its own and can be cached.  The cache maps such a chunk to the
bytes of its ids.  Arrow cuts a batch of texts into chunks and numbers the distinct ones,
so each of them is looked up once a batch; a text's ids are gathered by those numbers.
The chunks that a batch lacks are words, which the tokenizer's model encodes, or are
joined to a few long strings, with a line break between chunks: it is a token of its own
there, which no chunk holds, so the ids are cut at it again.  Punctuation that ends a
chunk behind a letter or digit is encoded on its own.  Tokenizers of another kind encode
whole texts.
"""

from __future__ import annotations

import json
import os
import re
import string
from array import array
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..operators.bpe import byte_chars

#: Chunks kept per worker, and the longest kept.  When the cache is full the
#: older half stays: frequent chunks are met first.
CACHE, LONGEST = 600_000, 64
#: Chunks in one string.
TOGETHER = 200
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Latin letters behind a space or alone: one pre-token.
_WORD = re.compile("( ?)[A-Za-zÀ-ÖØ-öø-ɏ]+")


def _unsafe(chunk: str) -> bool:
    """More white space at an end than one line break in front: the chunk is not
    encoded on its own."""
    word = chunk[1:] if chunk[:1] == "\n" else chunk
    return not word or word[0].isspace() or word[-1].isspace()


def _all_safe(chunks: list[str]) -> bool:
    """Whether no chunk holds white space but one line break in front, and none is empty."""
    joined = " ".join(chunks)
    words = joined.split()
    return len(words) == len(chunks) and (
        len("".join(words)) + joined.count(" ") + sum(c.startswith("\n") for c in chunks) == len(joined))


def _stem(chunk: str) -> str | None:
    """The chunk without the punctuation at its end, if a letter or digit is before."""
    stem = chunk.rstrip(string.punctuation)
    return stem if len(stem) < len(chunk) and stem[-1:].isalnum() else None


def _parted(data: bytes, dtype: str, mark: int) -> list[bytes]:
    """Ids cut at each id ``mark``, which goes."""
    size = np.dtype(dtype).itemsize
    ends = (np.flatnonzero(np.frombuffer(data, dtype) == mark) * size).tolist()
    return [data[b:e] for b, e in zip([0, *[e + size for e in ends]], [*ends, len(data)], strict=True)]


class ChunkEncoder:
    """Ids of texts, equal to encoding each whole text.

    ``encode_many(strings)`` gives the ids of each string as bytes of ``dtype``.
    ``added``: tokens that are matched before pre-tokenization; a text that holds
    one is encoded whole, as is any text if ``whole`` is set.  ``encode_words``: ids of
    pre-tokens of letters, where the library offers that."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], dtype: str, added: list[str],
                 whole: bool = False, encode_words: Callable[[list[str]], list[bytes]] | None = None):
        self.encode_many, self.dtype, self.added, self.whole = encode_many, dtype, added, whole
        self.encode_words = encode_words
        self.chunks: dict[str, bytes] = {}
        self.line_break = b"" if whole else encode_many(["\n"])[0]
        #: Strings can be joined by a line break if that is one token and no added token spans it.
        self.joins = len(self.line_break) == np.dtype(dtype).itemsize and not any(
            c.isspace() for a in added for c in a)

    def encode_all(self, strings: list[str]) -> list[bytes]:
        """Ids of each string.  Words go to the tokenizer's model, others without a line
        break and with no white space at their ends but one space in front are joined to
        long strings."""
        if not self.joins:
            return self.encode_many(strings)
        out, words, plain, other = [b""] * len(strings), [], [], []
        word = _WORD.fullmatch if self.encode_words else lambda s: None
        for i, s in enumerate(strings):
            if word(s):
                words.append(i)
            elif s:
                ok = not s[-1].isspace() and not s[s[0] == " "].isspace() and "\n" not in s
                (plain if ok else other).append(i)
        for some, encode in ((words, self.encode_words), (other, self.encode_many)):
            if some:
                for i, ids in zip(some, encode([strings[i] for i in some]), strict=True):
                    out[i] = ids
        mark = np.frombuffer(self.line_break, self.dtype)[0]
        for at in range(0, len(plain), TOGETHER):
            group = plain[at:at + TOGETHER]
            data = self.encode_many(["\n".join([strings[i] for i in group])])[0]
            for i, ids in zip(group, _parted(data, self.dtype, mark), strict=True):
                out[i] = ids
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks as they stand in a text: behind a space, or behind the line
        break they begin with."""
        if not self.joins:
            return self.encode_many([c if c[0] == "\n" else " " + c for c in chunks])
        found = self.encode_all([c[1:] if c[0] == "\n" else " " + c for c in chunks])
        return [self.line_break + ids if c[0] == "\n" else ids for c, ids in zip(chunks, found, strict=True)]

    def ids(self, text: str) -> np.ndarray:
        return self.batch([text])[0]

    def batch(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each text; a few hundred texts at a time are a good batch."""
        texts = list(texts)
        ends = [(t, "") for t in texts]  # what stands before and behind the chunks
        cut = [] if self.whole else [i for i, t in enumerate(texts) if not any(a in t for a in self.added)]
        row, number, names, found = self._chunks(texts, cut, ends)
        new = [c for c, ids in zip(names, found, strict=True) if ids is None]
        self._learn(new)
        for k in [k for k, ids in enumerate(found) if ids is None]:
            found[k] = self.chunks[names[k]]
        sizes = np.cumsum([0, *map(len, found)], dtype=np.int64)
        _, offsets, data = pa.Array.from_buffers(pa.large_binary(), len(found), [
            None, pa.py_buffer(sizes), pa.py_buffer(b"".join(found))]).take(number).buffers()
        begin = np.frombuffer(offsets, np.int64)[np.searchsorted(row, np.arange(len(texts) + 1))].tolist()
        data, outer = memoryview(data or b""), self.encode_all([x for pair in ends for x in pair])
        out = [np.frombuffer(b"".join([outer[2 * i], data[begin[i]:begin[i + 1]], outer[2 * i + 1]]), dtype=self.dtype)
               for i in range(len(texts))]
        for c in new:
            if len(c) > LONGEST:
                self.chunks.pop(c, None)
                self.chunks.pop(_stem(c), None)
        if len(self.chunks) > CACHE:
            self.chunks = dict(islice(self.chunks.items(), CACHE // 2))
        return out

    def _chunks(self, texts: list[str], cut: list[int], ends: list[tuple[str, str]]
                ) -> tuple[np.ndarray, pa.Array, list[str], list[bytes | None]]:
        """The chunks of the texts ``cut``, in order: each one's text, its number, and the
        distinct chunks with their ids, if known; what stands around them goes to ``ends``."""
        lists = pc.split_pattern(pa.array([texts[i].replace("\n", " \n") for i in cut], pa.large_string()), " ")
        at, words = lists.offsets.to_numpy(), lists.values
        row = np.repeat(np.array(cut, dtype=np.int64), np.diff(at))
        inner = np.ones(len(words), dtype=bool)
        inner[at[:-1]] = False
        first, row, words = words.take(pa.array(at[:-1])).to_pylist(), row[inner], words.filter(pa.array(inner))
        number, names, found = self._look_up(words)
        new = [c for c, ids in zip(names, found, strict=True) if ids is None]
        odd = set()
        if not _all_safe(new):
            unsafe = np.array([ids is None and _unsafe(c) for c, ids in zip(names, found, strict=True)], dtype=bool)
            odd.update(row[unsafe[number.to_numpy()]].tolist())
        for i, f, n in zip(cut, first, np.diff(at).tolist(), strict=True):
            ends[i] = (f, "")
            if n > 1 and (not f or f[-1].isspace()):
                odd.add(i)
        if odd:  # other white space than single spaces and line breaks between other characters
            plain = ~np.isin(row, list(odd))
            rows, rests = [row[plain]], []
            for i in sorted(odd):
                head, *rest = _SAFE_SPACE.split(texts[i])
                last = " " + rest.pop() if rest and rest[-1][-1].isspace() else ""  # only a text's end can be white space here
                ends[i] = (head, last)
                rows.append(np.full(len(rest), i))
                rests += rest
            row = np.concatenate(rows)
            order = np.argsort(row, kind="stable")
            row, words = row[order], pa.concat_arrays(
                [words.filter(pa.array(plain)), pa.array(rests, pa.large_string())]).take(pa.array(order))
            number, names, found = self._look_up(words)
        return row, number, names, found

    def _look_up(self, words: pa.Array) -> tuple[pa.Array, list[str], list[bytes | None]]:
        coded = words.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        return coded.indices, names, list(map(self.chunks.get, names))

    def _learn(self, new: list[str]) -> None:
        """Put the ids of chunks that are not there into the cache."""
        stems = {c: stem for c in new if not c[-1].isalnum() and (stem := _stem(c))}
        fresh = list(set(new).difference(stems).union(set(stems.values()).difference(self.chunks)))
        self.chunks.update(zip(fresh, self.encode_chunks(fresh), strict=True))
        tails = list({c[len(stem):] for c, stem in stems.items()})
        tail = dict(zip(tails, self.encode_all(tails), strict=True))
        get = self.chunks.__getitem__
        self.chunks.update({c: get(stem) + tail[c[len(stem):]] for c, stem in stems.items()})


def id_type(path: str) -> str:
    """The narrowest little-endian type for the tokenizer's ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    top = max([len(spec["model"]["vocab"]), *(t["id"] + 1 for t in spec["added_tokens"])])
    return "<u2" if top <= 1 << 16 else "<u4"


def _unmerged_byte(model: dict, printable: dict[int, str]) -> int | None:
    """A byte that UTF-8 never holds and that the model merges with no other: between two
    words it leaves the ids of both as they are."""
    if model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix") or (
            model.get("end_of_word_suffix")):
        return None
    merged = {c for pair in model["merges"] for part in pair for c in part}
    return next((b for b in (0xFF, 0xFE, 0xFD, 0xC0, 0xC1) if printable[b] in model["vocab"]
                 and printable[b] not in merged), None)


@lru_cache(maxsize=4)
def library_encoder(path: str) -> ChunkEncoder:
    """An encoder by the tokenizers library; one per worker and file."""
    from tokenizers import Tokenizer
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    dtype = id_type(path)
    pre = spec.get("pre_tokenizer") or {}
    chunked = (spec["model"]["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex")
               and not pre.get("add_prefix_space") and not spec.get("normalizer"))
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel unit
    code = {2: "H", 4: "I"}[np.dtype(dtype).itemsize]
    batch = getattr(tok, "encode_batch_fast", tok.encode_batch)

    def encode_many(strings: list[str]) -> list[bytes]:
        return [array(code, e.ids).tobytes() for at in range(0, len(strings), TOGETHER)
                for e in batch(strings[at:at + TOGETHER], add_special_tokens=False)]

    model, printable = tok.model, dict(enumerate(byte_chars()))  # a character per byte
    mark = _unmerged_byte(spec["model"], printable) if chunked else None

    def tokenize(data: bytes) -> bytes:
        return array(code, [t.id for t in model.tokenize(data.decode("latin-1").translate(printable))]).tobytes()

    def encode_words(words: list[str]) -> list[bytes]:
        if mark is None:
            return [tokenize(w.encode()) for w in words]
        cut = spec["model"]["vocab"][printable[mark]]
        return [ids for at in range(0, len(words), TOGETHER) for ids in _parted(
            tokenize(bytes([mark]).join([w.encode() for w in words[at:at + TOGETHER]])), dtype, cut)]

    return ChunkEncoder(encode_many, dtype, [t["content"] for t in spec["added_tokens"]], whole=not chunked,
                        encode_words=encode_words if chunked else None)
