"""Token ids of whole texts with the ``tokenizers`` library, fast enough for
corpora: ids of a space-separated chunk do not depend on its neighbours, so
each Python worker keeps a bounded chunk -> ids cache.  The unseen chunks of
many texts are cut into pre-tokens at once, and the unseen ones of these go
through the library as joined texts.

Why this is exact.  Both kinds of vocabulary file used here first cut the
text into pre-tokens with a regular expression and then merge inside a
pre-token only.

* byte-level files: a pre-token may start with one space but never continues
  across one, so a text may be cut before every single space that stands
  between two characters that are not white space.  Texts with any other
  spacing are looked up by their pre-tokens.  In a joined text the ids of a
  chunk begin at its only token that starts with a space.
* files that drop white space: a text may be cut at every space or line feed.
  In a joined text the ids of a pre-token end at its only token with the
  end-of-word suffix.

With ``added_tokens`` a string of one of the file's added tokens (such as
``<|endoftext|>``) is that token's id, as in the library's plain call; the texts
between such strings are encoded one by one, as the library does.  Without it these
strings are ordinary text.
"""

from __future__ import annotations

import os
import re

#: most cached entries per Python worker; beyond it unseen chunks are still
#: encoded, only not remembered
CACHE_ENTRIES = 600_000
#: longer chunks are never cached
CACHE_CHARS = 40
#: below this code point the pre-token expression is applied here; chunks
#: with later characters go through the library whole
SIMPLE_BELOW = "ɐ"
#: characters of texts that are looked up before the unseen chunks are encoded
CHARS_AT_ONCE = 1 << 19
#: strings of one joined text
JOINED = 4096
#: starts the keys of byte-level files that stand after no space
BARE = "\0"
#: ASCII marks between a letter or digit and a space: pre-tokens of their own
ENDING = re.compile(r"[!-/:-@\[-`{-~](?<=[A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff].)[!-/:-@\[-`{-~]* ")


class Encoder:
    """``encode(texts) -> list[bytes]``: little-endian ids of every text.

    Keys of the cache are chunks.  In byte-level files a chunk stands after a
    space; a key that starts with BARE is the string behind it, without one."""

    def __init__(self, path: str, cache_entries: int = CACHE_ENTRIES, added_tokens: bool = False):
        import json
        from array import array

        import numpy as np
        import regex
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        spec = json.loads(Tokenizer.from_file(path).to_str())
        added = spec["added_tokens"] if added_tokens else []
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens that look at their neighbours are not known here")
        # texts are cut at added tokens here, so the library is given none
        self.tok = Tokenizer.from_str(json.dumps({**spec, "added_tokens": []}))
        self.model, self.array = self.tok.model, array
        self.added = {t["content"]: t["id"] for t in added}
        # the longest of those that start at one place, as in the library
        self.marks = regex.compile("(" + "|".join(
            map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        vocabulary = spec["model"]["vocab"]
        self.size = 1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])])
        self.code, self.dtype = ("H", "<u2") if self.size <= 1 << 16 else ("I", "<u4")
        pre = spec["pre_tokenizer"]
        self.drops_space = pre["type"] == "Sequence"
        # byte-level files show a byte as itself where it is printable, else
        # as the next free character from U+0100 on
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        odd = [b for b in range(256) if b not in plain]
        self.shown = {b: chr(0x100 + i) for i, b in enumerate(odd)}
        late = [SIMPLE_BELOW + "-\U0010ffff"]
        if self.drops_space:
            # fixed value: the expression stands in the vocabulary file
            self.rx = regex.compile(pre["pretokenizers"][0]["pattern"]["Regex"] + "| ")
            edges = [i for t, i in vocabulary.items() if t.endswith(spec["model"]["end_of_word_suffix"])]
            # and earlier ones that are white space or whose normal form is not one earlier character
            normal = self.tok.normalizer.normalize_str
            late += [re.escape(c) for c in map(chr, range(ord(SIMPLE_BELOW)))
                     if c != " " and (c.isspace() or len(normal(c)) != 1 or normal(c).isspace() or normal(c) >= SIMPLE_BELOW
                     or normal(normal(c)) != normal(c) or normal(c) != c.lower())]
        else:
            import public_tokenizers
            self.rx = regex.compile(public_tokenizers.PATTERN)
            edges = [i for t, i in vocabulary.items() if t.startswith(self.shown[0x20])]
        self.late = re.compile(f"[{''.join(late)}]").search
        self.edge = np.zeros(self.size, bool)
        self.edge[edges] = True
        self.cache: dict[str, bytes] = {}
        self.room = cache_entries

    def _whole(self, s: str) -> bytes:
        """A string through the library as it is."""
        return self.array(self.code, self.tok.encode_batch_fast([s], add_special_tokens=False)[0].ids).tobytes()

    def _piece(self, p: str) -> bytes:
        """One pre-token: the library's merges on its byte-level form."""
        s = p if p.isascii() and p.isalpha() else p.encode().decode("latin-1").translate(self.shown)
        return self.array(self.code, [t.id for t in self.model.tokenize(s)]).tobytes()

    def _joined(self, chunks: list[str]) -> list[bytes]:
        """Chunks (without white space: pre-tokens) through the library as joined texts."""
        import numpy as np

        out, w, before = [], np.dtype(self.dtype).itemsize, "" if self.drops_space else " "
        for i in range(0, len(chunks), JOINED):
            some = chunks[i:i + JOINED]
            ids = self._whole(before + " ".join(some))
            at = np.flatnonzero(self.edge[np.frombuffer(ids, self.dtype)]) * w
            ends = (at + w).tolist() if self.drops_space else [*at[1:].tolist(), len(ids)]
            if len(at) == len(some):
                out += [ids[a:z] for a, z in zip([0, *ends], ends)]
            else:
                out += [self._whole(before + c) for c in some]
        return out

    def _cut(self, chunks: list[str]) -> list[list[str]]:
        """Chunks without late characters -> the keys of their pre-tokens."""
        s, out = " ".join(chunks), []
        if self.drops_space:
            s = " " + (s.lower() if s.isascii() else self.tok.normalizer.normalize_str(s))
            for p in self.rx.findall(s) if chunks else ():
                if p == " ":
                    out.append([])
                else:
                    out[-1].append(p)
        else:
            for p in self.rx.findall(" " + s) if chunks else ():
                if p[0] == " ":
                    out.append([p[1:]])
                else:
                    out[-1].append(BARE + p)
        return out

    def _bare(self, s: str) -> bytes:
        """A string that stands after no space (byte-level files)."""
        if s.isascii() and s.isalpha():
            return self._piece(s)
        return self._whole(s) if self.late(s) else b"".join(map(self._piece, self.rx.findall(s)))

    def solve(self, keys: list[str]) -> dict[str, bytes]:
        """Ids of distinct keys that are not remembered."""
        solved, words, whole, chunks = {}, {}, [], []
        for c in keys:
            if c.isascii() and c.isalpha() and (c.islower() or not self.drops_space):
                words[c] = None
            elif not c:
                solved[c] = b""
            elif not self.drops_space and c[0] == BARE:
                solved[c] = self._bare(c[1:])
            elif self.late(c):
                whole.append(c)
            else:
                chunks.append(c)
        cut, known = self._cut(chunks), self.cache.get
        for ks in cut:
            for k in ks:
                if k not in words:
                    words[k] = known(k)
        unseen = [k for k, ids in words.items() if ids is None]
        if not self.drops_space:
            words.update((k, self._bare(k[1:])) for k in unseen if k[0] == BARE)
            unseen = [k for k in unseen if k[0] != BARE]
        words.update(zip(unseen, self._joined(unseen)))
        solved.update(zip(whole, map(self._whole, whole) if self.drops_space else self._joined(whole)))
        solved.update((c, b"".join([words[k] for k in ks])) for c, ks in zip(chunks, cut))
        words.update(solved)
        for c, ids in words.items():
            if len(self.cache) >= self.room:
                break
            if len(c) <= CACHE_CHARS:
                self.cache[c] = ids
        return words

    def _keys(self, t: str) -> list[str]:
        """The keys of a text without added tokens."""
        if self.drops_space:
            t = t.replace("\n", " ")
            if t.isascii() or not self.late(t):
                t = t.lower()
            return ENDING.sub(r" \g<0>", t).split(" ")
        if not t:
            return []
        if BARE not in t and not (t[0].isspace() or t[-1].isspace()) and _even(t):
            if _lone(t):
                t = t.replace("\n", f" {BARE}\n {BARE}")
            return (BARE + ENDING.sub(rf" {BARE}\g<0>", t)).split(" ")
        if self.late(t):
            return [BARE + t]
        return [p[1:] if p[0] == " " and not p.isspace() and p[1] != BARE else BARE + p for p in self.rx.findall(t)]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Texts without added tokens."""
        get, unseen, out, held = self.cache.get, {}, [], []
        for t in texts:
            keys = self._keys(t)
            got = list(map(get, keys))
            gaps = [i for i, ids in enumerate(got) if ids is None]
            if gaps:
                missed = [keys[i] for i in gaps]
                unseen.update(dict.fromkeys(missed))
                held.append((len(out), got, gaps, missed))
                out.append(b"")
            else:
                out.append(b"".join(got))
        solved = self.solve(list(unseen))
        for n, got, gaps, missed in held:
            for i, c in zip(gaps, missed):
                got[i] = solved[c]
            out[n] = b"".join(got)
        return out

    def _marked(self, texts: list[str]) -> list[bytes]:
        """Texts that may hold added tokens: text, token, text, token, ..."""
        parts = [self.marks.split(t) if any(m in t for m in self.added) else [t] for t in texts]
        plain = iter(self._plain([p for ps in parts for p in ps[::2]]))
        return [b"".join(self.array(self.code, [self.added[p]]).tobytes() if i % 2 else next(plain)
                         for i, p in enumerate(ps)) for ps in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        out, some, held = [], [], 0
        for t in texts:
            some.append(t)
            held += len(t)
            if held >= CHARS_AT_ONCE:
                out += self._marked(some)
                some, held = [], 0
        return out + self._marked(some)


_SPACED: list = []


def _even(t: str) -> bool:
    """Whether every space of ``t`` stands between two characters that are not
    white space."""
    if not _SPACED:
        import regex
        _SPACED.append(regex.compile(r" (?=[\s\x1c-\x1f\x85])|(?<=[\s\x1c-\x1f\x85]) "))
    if "  " in t or "\n " in t or " \n" in t:
        return False
    return t.isascii() and not any(c in t for c in _ODD) or _SPACED[0].search(t) is None


def _lone(t: str) -> bool:
    """Whether no line feed of ``t`` stands beside white space."""
    if "\n\n" in t or not t.isascii() and _BESIDE.search(t):
        return False
    return not t.isascii() or not any(c in t for c in _ODD)


_BESIDE = re.compile(r"\n(?=[\s\x85])|(?<=[\s\x85])\n")
_ODD = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f"

_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, added_tokens: bool = False) -> Encoder:
    """The worker's encoder of one vocabulary file (kept between tasks)."""
    key = path, added_tokens
    if key not in _ENCODERS:
        _ENCODERS.clear()  # one cache per worker keeps its memory bounded
        _ENCODERS[key] = Encoder(path, added_tokens=added_tokens)
    return _ENCODERS[key]
