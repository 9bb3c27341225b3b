"""Byte-level pair merging on ragged numpy arrays: one merge per sequence and round, many sequences at once."""

from __future__ import annotations

import json

import numpy as np
import regex

NONE = np.iinfo(np.int32).max
#: Split rule of byte-level vocabularies whose file says ``use_regex`` (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts beyond this length are cut into words one after the other, not all at once.
AT_ONCE = 1_000_000
#: Entries that a worker remembers; when there are more it forgets them all. Memory only, never results.
REMEMBERED = 400_000
#: Longer pieces are not remembered.
SHORT = 48


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class PairMerger:
    """The vocabulary as arrays, and the merging of many byte strings at once."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, splitter = content["model"], content["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or splitter.get("type") != "ByteLevel" or splitter.get("add_prefix_space")
                or not splitter.get("use_regex", True) or content["normalizer"] or model.get("ignore_merges")):
            raise ValueError("only plain byte-level vocabularies are counted here")
        vocab = model["vocab"]
        self.byte_ids = np.array([vocab[c] for c in _byte_letters()], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right = (np.array([vocab[p[i]] for p in pairs], np.int64) for i in (0, 1))
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        order = np.argsort(left << 32 | right)
        self._keys, self._ranks = (left << 32 | right)[order], order.astype(np.int32)
        added = {t["content"]: t["id"] for t in content["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in content["added_tokens"]):
            raise ValueError("added tokens with own rules are not supported")
        self.added = added
        self._vocab = vocab

    def ranked_bytes(self) -> dict[bytes, int]:
        """Each entry's bytes and id, for encoders that take ids as ranks."""
        if (np.diff(self.merged) <= 0).any():
            raise ValueError("ids do not follow the order of merges")
        letters = {c: b for b, c in enumerate(_byte_letters())}
        added = set(self.added)
        return {bytes(letters[c] for c in entry): i for entry, i in self._vocab.items() if entry not in added}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where(self._keys[at] == key, self._ranks[at], NONE).astype(np.int32)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in a row, and how many each piece has.

        Each round finds the lowest rank in every sequence and merges all its places there, left before right
        where two overlap, so after r rounds every sequence has done its r lowest merges. Sequences without a
        known pair leave the arrays.
        """
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        counts = np.zeros(len(pieces), np.int64)
        if not len(symbols):
            return symbols, counts
        ranks = np.full(len(symbols), NONE, np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[inner] = self._rank(symbols[inner], symbols[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            sizes = np.diff(np.append(starts, len(symbols)))
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), sizes)
            over = lowest == NONE
            if over.any():
                done.append((owner[over], symbols[over]))
                symbols, owner, ranks, lowest = (x[~over] for x in (symbols, owner, ranks, lowest))
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == lowest)
            first = np.concatenate(([True], np.diff(at) != 1))
            at = at[(at - at[first][np.cumsum(first) - 1]) % 2 == 0]
            symbols[at] = self.merged[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, ranks = symbols[keep], owner[keep], ranks[keep]
            at -= np.arange(len(at))
            for i in (at, at[at > 0] - 1):
                i = i[i + 1 < len(symbols)]
                same = owner[i] == owner[np.minimum(i + 1, len(owner) - 1)]
                ranks[i[~same]] = NONE
                ranks[i[same]] = self._rank(symbols[i[same]], symbols[i[same] + 1])
            if len(at) and at[-1] == len(symbols) - 1:
                ranks[-1] = NONE
        owner = np.concatenate([o for o, _ in done])
        symbols = np.concatenate([s for _, s in done])
        counts += np.bincount(owner, minlength=len(pieces))
        return symbols[np.argsort(owner, kind="stable")], counts


class WordEncoder:
    """Ids of text parts by the split rule and the pair merger."""

    def __init__(self, path: str):
        self.merger = PairMerger(path)
        self.words = regex.compile(WORDS)
        self.added = self.merger.added

    def _split(self, part: str) -> list[str]:
        word = part[1:] if part[:1] == " " else part
        if word.isalpha():
            return [part]
        if word[:-1].isalpha() and word[-1] in ".,;:!?":
            return [part[:-1], part[-1]]
        return self.words.findall(part)

    def encode(self, parts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each part; equal words are merged once."""
        words = [self._split(p) for p in parts]
        distinct = list({w for ws in words for w in ws})
        ids, counts = self.merger.merge([w.encode() for w in distinct])
        raw, ends = ids.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
        known = {w: raw[e - 4 * n:e] for w, e, n in zip(distinct, ends, counts.tolist())}
        return [known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) for ws in words]

    def whole(self, text: str) -> bytes:
        """A text cut by the split rule, some thousand words at a time."""
        out, block = [], []
        for match in self.words.finditer(text):
            block.append(match.group())
            if len(block) == 100_000:
                out.append(b"".join(self.encode(block)))
                block = []
        return b"".join([*out, *self.encode(block)])


class TextEncoder:
    """Ids of whole texts as packed little-endian unsigned 32-bit integers.

    A text is cut at single spaces; a part between them that neither begins nor ends with white space is encoded
    the same wherever it stands, so parts are remembered. Texts with other white space around a space are encoded
    as a whole. ``words`` encodes the parts that are new, and such texts.
    """

    def __init__(self, words):
        self.words = words
        self.added = words.added
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))
                                         + ")") if self.added else None
        self.parts: dict[str, bytes] = {}

    def _cut(self, text: str) -> tuple[list[str], list[str]] | None:
        """The parts whose encodings, joined, are that of the text, and the new ones among them; None if the text is
        to be cut as a whole. Only parts that pass the test are ever remembered, so known ones need none."""
        if len(text) > AT_ONCE:
            return None
        first, *rest = text.split(" ")
        parts = [" " + x for x in rest]
        known = self.parts
        new = [p for p in parts if p not in known]
        if any([len(p) == 1 or p[1].isspace() or p[-1].isspace() for p in new]) or rest and first[-1:].isspace():
            return None
        return ([first] + parts, new + [first]) if first else (parts, new)

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.parts) > REMEMBERED:
            self.parts.clear()
        cut: list[list[list[str] | str | int]] = []
        new: set[str] = set()
        for text in texts:
            whole = []
            for piece in self.split_added.split(text) if self.split_added else [text]:
                if piece in self.added:
                    whole.append(self.added[piece])
                    continue
                parts = self._cut(piece)
                whole.append(piece if parts is None else parts[0])
                if parts is not None:
                    new.update(parts[1])
            cut.append(whole)
        pieces = list(new)
        fresh = dict(zip(pieces, self.words.encode(pieces)))
        self.parts.update(fresh)
        both = self.parts
        out = [b"".join([x.to_bytes(4, "little") if isinstance(x, int) else self.words.whole(x)
                         if isinstance(x, str) else b"".join([both[p] for p in x]) for x in whole]) for whole in cut]
        for p in [p for p in fresh if len(p) > SHORT]:
            del both[p]
        return out
