"""Byte-level BPE inside a task: the tokenizers library, asked once per
distinct piece of text.

A piece starts at a blank that follows or precedes a non-blank.  The
pre-tokenizer of a byte-level vocabulary always starts a token there: a token
ends before a blank unless it is white space itself, and of a white-space run
before a non-blank it leaves exactly the last blank to the next token.  A
single line end between non-blanks is a token of its own and starts a piece,
too.  So the ids of a text are the ids of its pieces, one after another.  A
tokenizer of another kind gets whole texts.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import threading
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from footfall.llm.common import release_memory, reuse_memory

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
MAX_PIECES = 200_000          # distinct pieces remembered by one worker, and as many older ones
WORD_BYTES = 24_000_000       # of a column's words and their ids that one worker remembers
IDLE_SECONDS = 5              # after so long without a task a worker forgets them
SLICE_BYTES = 4_000_000       # text that is split together
MAX_TOKENS = 10_000           # distinct runs of punctuation remembered, too
BATCH_WORDS = 1_000           # new words of a slice that the library gets in one call
TEXT_WORDS = 32               # of them in one text
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_TWO_BLANKS = re.compile(r"\s\s")
_TWO_BLANKS_RE2 = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\p{Z}]{2}"      # the same in Arrow's syntax
_WORD_RE2 = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+$"       # Latin letters alone
_pack = struct.Struct("<I").pack
_UNSAFE = re.compile(r"\s (?:\s|\Z)")
_CUT = re.compile(r"(?<=\S) | (?=\S)")
_NO_WORDS = pa.array([], pa.string()), pa.array([], pa.large_binary())


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    """Path of a vocabulary file: a path as it is, else a public name."""
    if os.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level token stands for: visible
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class PieceEncoder:
    """Encodes and decodes like the library, without special tokens added."""

    def __init__(self, vocabulary: str = DEFAULT_VOCABULARY):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        path = vocabulary_path(vocabulary)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.merges = Tokenizer(self.model)           # of words parted by blanks, in the model's characters
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                         and not pre.get("add_prefix_space") and spec.get("normalizer") is None
                         and not any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added))
        self.special = {a["content"]: a["id"] for a in added}
        self.special_cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        # two blanks in a row of any kind, or a special token; everything for another kind of tokenizer
        self.not_simple = "|".join([_TWO_BLANKS_RE2, *map(re.escape, self.special)]) if self.by_piece else ""
        # words may stand in one text if none of their blanks can belong to a special token
        self.joins = self.by_piece and not any(c.isspace() for t in self.special for c in t)
        self.to_chars = {b: c for c, b in byte_of_char().items()}
        self.blank = self.to_chars[32]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}      # the pieces before these, dropped when these are full
        self.words = _NO_WORDS                 # of columns and their ids, those used last first
        self._tokens: dict[str, bytes] = {}
        self._timer: threading.Timer | None = None
        self._bytes: list[bytes] | None = None
        self._blanks: np.ndarray | None = None

    def __enter__(self) -> PieceEncoder:
        """For the time of a task; pieces are kept for a task that follows soon."""
        if self._timer is not None:
            self._timer.cancel()
        reuse_memory()
        return self

    def __exit__(self, *_) -> None:
        self._timer = threading.Timer(IDLE_SECONDS, self._forget)
        self._timer.daemon = True
        self._timer.start()

    def _forget(self) -> None:
        self.known, self.older = {}, {}
        self.words = _NO_WORDS
        gc.collect()
        release_memory()

    @property
    def pieces(self) -> dict[str, bytes]:
        """What is remembered, without the older pieces."""
        return dict(zip(*map(pa.Array.to_pylist, self.words), strict=True)) | self.known

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _token(self, text: str) -> bytes:
        """Merges of one pre-token."""
        got = self.model.tokenize(text.encode().decode("latin-1").translate(self.to_chars))
        return b"".join([_pack(t.id) for t in got])

    def _piece(self, piece: str, before: str = " ") -> bytes:
        """Ids of a blank (or nothing, at a text's start) and ``piece``, or of
        a ``piece`` that starts with a line end.  Latin letters and then punctuation without apostrophes are
        two pre-tokens, which the model's merges get as they are; anything
        else goes through the library's own pre-tokenizer."""
        core = piece.rstrip(_PUNCTUATION)
        lead = core[:1] == "\n"
        word = core[1:] if lead else core
        if not word.isalpha() or not word.isascii() and max(word) > "\u024f":
            return self._whole(piece if lead else before + piece)
        tail = piece[len(core):]
        if tail and before and not lead:         # the word alone may be known
            out = self.known.get(core) or self.older.get(core)
            if out:
                return out + self._known(tail)
        if word.isascii():                       # visible ASCII stands for itself
            out = b"".join([_pack(t.id) for t in self.model.tokenize(
                word if lead or not before else self.blank + word)])
            out = self._known("\n") + out if lead else out
        else:
            out = self._known("\n") + self._token(word) if lead else self._token(before + word)
        return out + self._known(tail) if tail else out

    def _known(self, token: str) -> bytes:
        ids = self._tokens.get(token)
        if ids is None:
            if len(self._tokens) >= MAX_TOKENS:
                self._tokens.clear()
            ids = self._tokens[token] = self._token(token)
        return ids

    def _lookup(self, parts: list[str]) -> bytes:
        known = self.known
        try:
            return b"".join(map(known.__getitem__, parts))
        except KeyError:
            return b"".join(self._learned(parts))

    def _learned(self, parts: list[str]) -> list[bytes]:
        if len(self.known) > MAX_PIECES:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        out = list(map(known.get, parts))
        merges, blank, tokens = self.model.tokenize, self.blank, self._tokens
        for k, ids in enumerate(out):
            if ids is None:
                p = parts[k]
                ids = older.get(p)
                if ids is None:
                    core = p.rstrip(_PUNCTUATION)
                    if core != p and core.isalpha() and (core.isascii() or max(core) <= "\u024f"):
                        # a word is remembered without what follows it
                        ids = known.get(core) or older.get(core)
                        if ids is None:
                            ids = (b"".join([_pack(t.id) for t in merges(blank + core)]) if core.isascii()
                                   else self._token(" " + core))
                        known[core] = ids
                        tail = p[len(core):]
                        out[k] = ids + (tokens.get(tail) or self._known(tail))
                        continue
                    if p.isalpha() and p.isascii():         # a pre-token as it is
                        ids = b"".join([_pack(t.id) for t in merges(blank + p)])
                    else:
                        ids = self._piece(p)
                out[k] = known[p] = ids
        return out

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of a blank and each of ``words``, which are Latin letters.  ASCII
        stands for itself, so the merges get it as it is; the library's own
        pre-tokenizer turns other letters into bytes."""
        is_ascii = pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
        plain, other = np.flatnonzero(is_ascii), np.flatnonzero(~is_ascii)
        order = np.empty(len(words), np.int64)
        order[np.concatenate([plain, other])] = np.arange(len(words))
        return pa.concat_arrays([
            self._joined(words.take(pa.array(plain)).to_pylist(), self.merges, " " + self.blank),
            self._joined(words.take(pa.array(other)).to_pylist(), self.tokenizer if self.joins else None, " "),
        ]).take(pa.array(order))

    def _joined(self, words: list[str], library, before: str) -> pa.Array:
        """Ids of a blank and each of ``words``: ``library`` gets many in one
        text, and each starts at the one token that starts with its blank."""
        found, sizes = [np.empty(0, "<u4")], [np.zeros(1, np.int64)]
        for k in range(0, len(words), BATCH_WORDS):
            some = words[k:k + BATCH_WORDS]
            at = None
            if library is not None:
                texts = [before + before.join(some[j:j + TEXT_WORDS]) for j in range(0, len(some), TEXT_WORDS)]
                got = library.encode_batch_fast(texts, add_special_tokens=False)
                ids = np.concatenate([np.array(x.ids, "<u4") for x in got])
                at = np.flatnonzero(self._starts_blank()[ids])
            if at is None or len(at) != len(some):         # another kind of vocabulary
                each = [np.frombuffer(self._token(" " + w), "<u4") for w in some]
                ids, size = np.concatenate(each), np.array(list(map(len, each)))
            else:
                size = np.diff(at, append=len(ids))
            found.append(ids), sizes.append(size)
        edges = 4 * np.cumsum(np.concatenate(sizes))
        return pa.Array.from_buffers(pa.large_binary(), len(words), [
            None, pa.py_buffer(edges), pa.py_buffer(np.concatenate(found))])

    def _starts_blank(self) -> np.ndarray:
        """Of each id, whether its bytes start with a blank."""
        if self._blanks is None:
            self._blanks = np.array([b[:1] == b" " for b in self.token_bytes()])
        return self._blanks

    def _column_words(self, words: pa.Array) -> pa.Array:
        """Ids of a blank and each of ``words``, distinct and of Latin letters.
        Those used last are remembered, up to WORD_BYTES."""
        known, known_ids = self.words
        at = pc.index_in(words, value_set=known)
        new = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        at = at.fill_null(0).to_numpy().astype(np.int64)
        at[new] = len(known) + np.arange(len(new))
        known_ids = pa.concat_arrays([known_ids, self._words(words.take(pa.array(new)))])
        ids = known_ids.take(pa.array(at))
        unused = np.ones(len(known_ids), bool)
        unused[at] = False
        rest = pa.array(np.flatnonzero(unused))
        known = pa.concat_arrays([words, known.take(rest)])
        known_ids = pa.concat_arrays([ids, known_ids.take(rest)])
        size = pc.binary_length(known).to_numpy() + pc.binary_length(known_ids).to_numpy() + 12     # and offsets
        keep = int(np.searchsorted(np.cumsum(size), WORD_BYTES, "right"))
        if keep < len(size):         # a copy, so that what is left out is freed
            keep = pa.array(np.arange(keep))
            known, known_ids = known.take(keep), known_ids.take(keep)
        self.words = known, known_ids
        return ids

    def _distinct(self, pieces: pa.Array) -> pa.Array:
        """Ids of a column of distinct pieces, each after a blank.  Latin
        letters are looked up, and remembered, without the punctuation after
        them; whatever else a piece is, it is looked up whole."""
        bare = pc.ascii_rtrim(pieces, characters=_PUNCTUATION)
        cores = bare.dictionary_encode()
        is_word = pc.match_substring_regex(cores.dictionary, _WORD_RE2)
        word_ids = self._column_words(cores.dictionary.filter(is_word))
        is_word = is_word.to_numpy(zero_copy_only=False)
        place = np.where(is_word, np.cumsum(is_word) - 1, -1)[cores.indices.to_numpy()]        # of a piece's ids
        tail = (pc.binary_length(pieces).to_numpy() - pc.binary_length(bare).to_numpy()) * (place >= 0)
        odd = np.flatnonzero(place < 0)
        place[odd] = len(word_ids) + np.arange(len(odd))
        odd_ids = self._odd(pieces.take(pa.array(odd)).to_pylist())
        ends, end = [b""], np.zeros(len(pieces), np.int64)       # what follows the words, and which of it a piece has
        for n in np.unique(tail[tail > 0]).tolist():
            rows = np.flatnonzero(tail == n)
            marks = pc.utf8_slice_codeunits(pieces.take(pa.array(rows)), -n).dictionary_encode()
            end[rows] = len(ends) + marks.indices.to_numpy()
            ends += map(self._known, marks.dictionary.to_pylist())
        binary = pa.large_binary()
        return pc.binary_join_element_wise(
            pa.concat_arrays([word_ids, pa.array(odd_ids, binary)]).take(pa.array(place)),
            pa.array(ends, binary).take(pa.array(end)), pa.scalar(b"", binary))

    def _odd(self, pieces: list[str]) -> list[bytes]:
        """Ids of a blank and each of the distinct ``pieces``."""
        if len(self.known) > MAX_PIECES:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        out = list(map(known.get, pieces))
        for k, ids in enumerate(out):
            if ids is None:
                p = pieces[k]
                ids = older.get(p)
                known[p] = out[k] = self._piece(p) if ids is None else ids
        return out

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens, as little-endian bytes."""
        if not text:
            return b""
        if _TWO_BLANKS.search(text):
            parts = _CUT.split(text) if _UNSAFE.search(text) else text.split(" ")
            parts[1:] = [p if p[:1] != "\n" else None for p in parts[1:]]
            if None in parts:                 # a blank, then a line end: left to the library
                return self._whole(text)
        else:                                 # single blanks and line ends: both start a piece
            parts = text.replace("\n", " \n").split(" ")
        return (self._whole(parts[0]) if parts[0] else b"") + self._lookup(parts[1:])

    def encode_bytes(self, text: str) -> bytes:
        """Ids as consecutive little-endian unsigned 32-bit integers."""
        if not self.by_piece:
            return self._whole(text)
        if not self.special_cut.search(text):
            return self._plain(text)
        out, at = [], 0
        for m in self.special_cut.finditer(text):
            out += [self._plain(text[at:m.start()]), np.array([self.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*out, self._plain(text[at:])])

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def encode_column(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For slices of a text column in order: (all ids, end of each text).

        Texts whose blanks are all single are split together in Arrow, their
        distinct pieces looked up once a slice, and the ids gathered."""
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(size) - size) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for a, b in zip(edges, edges[1:]):
            if a < b:
                yield self._slice(texts.slice(a, b - a))

    def each_bytes(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text, as little-endian bytes."""
        for ids, ends in self.encode_column(texts):
            raw, at = memoryview(ids.astype("<u4", copy=False)).cast("B"), 0
            for end in ends.tolist():
                yield raw[4 * at:4 * end].tobytes()
                at = end

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        first, plain = [], []
        alone = pc.match_substring_regex(texts, self.not_simple).to_pylist()
        for text, whole in zip(texts.to_pylist(), alone, strict=True):
            if whole:
                first.append(self.encode_bytes(text))          # as one piece
                plain.append("")
            else:
                head = text.split(" ", 1)[0].split("\n", 1)[0]
                first.append(self._piece(head, "") if head else b"")
                plain.append(text[len(head):])
        lists = pc.split_pattern(pc.replace_substring(pa.array(plain, pa.string()), "\n", " \n"), " ")
        words = lists.flatten().dictionary_encode()
        ids = self._distinct(words.dictionary)
        # what a list starts with (the empty text before the first blank) stands for the text's first piece
        index = words.indices.to_numpy().astype(np.int64)
        starts = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        index[starts] = len(ids) + np.arange(len(first))
        taken = pa.concat_arrays([ids, pa.array(first, pa.large_binary())]).take(pa.array(index))
        edges = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset)
        ends = edges[np.append(starts[1:], len(taken))]
        data = taken.buffers()[2]
        out = np.frombuffer(data, "<u4", int(ends[-1]) // 4) if ends[-1] else np.empty(0, "<u4")
        return out, ends // 4

    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for."""
        if self._bytes is None:
            chars = byte_of_char()
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
            self._bytes = [b""] * (max(vocabulary.values()) + 1)
            for token, i in vocabulary.items():
                self._bytes[i] = (token.encode() if token in self.special
                                  else bytes(chars[c] for c in token))
        return self._bytes

    def decode(self, ids: np.ndarray) -> str:
        """The library's ``decode(ids, skip_special_tokens=False)``."""
        if not self.by_piece:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        return b"".join(map(self.token_bytes().__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder_for(vocabulary: str = DEFAULT_VOCABULARY) -> PieceEncoder:
    """One encoder a Python worker: what it remembers serves later tasks."""
    return PieceEncoder(vocabulary)
