"""Token ids of texts, encoded with the tokenizers library inside tasks."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from assay.llm.textkit import slices

#: A word whose pre-tokens can be told by sight: letters that keep their number under NFC and lower-casing, then signs.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")
#: Words remembered per Python worker; beyond that, new words are encoded whenever they come.
_MOST_WORDS = 600_000


#: Words of every make, by which a tokenizer shows what it does with words and their parts.
_TRIED = ["a", "the", "The", "THE", "aBc", "x1", "2024", "3.14", "don't", "it's", "'s", "we'll", "O'Neil", "e-mail", "word,", "(see", "end.)", "...", "?!", "a/b", "U.S.", "é", "É", "Éa", "eau", "ß", "ÿ", "naïve.", "e\u0301", "\u0301a", "Ж", "ﬁ", "İ", "ǅ", "你好", "한", "🙂", "a\xa0b", "\x0b", "a\x0cb", "\u200b", "\u2028", "#tag", "@x", "<s>", "</w>", "_", "a_b", "\x00"]
#: Parts of normalisers under which a text's words are what they are by themselves.
_BY_WORD = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents", "BertNormalizer"}


def _steps(part: dict | None, inner: str) -> list[dict]:
    if not part:
        return []
    return [x for p in part[inner] for x in _steps(p, inner)] if part["type"] == "Sequence" else [part]


class Encoder:
    """Little-endian unsigned 32-bit ids of texts, without special tokens (their strings count as ordinary text).

    A tokenizer that drops white space and marks word ends encodes every space-separated word by itself, so
    words are encoded once per worker and looked up afterwards. One that also lower-cases and takes letters and signs apart
    has plain words put together from those. Both must hold for every pair of a mixed set of words, and
    the normaliser must be of known parts; any other tokenizer encodes whole words, or whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.vocab_size = self.tokenizer.get_vocab_size()
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.known: dict[str, bytes] = {"": b""}
        self.ends = np.zeros(self.vocab_size, bool)
        if self.suffix:
            for token, i in self.tokenizer.get_vocab().items():
                self.ends[i] = token.endswith(self.suffix)
        parts = _steps(json.loads(self.tokenizer.to_str()).get("normalizer"), "normalizers")
        known = all(p["type"] in _BY_WORD or p["type"] == "Replace" and p["pattern"] == {"Regex": "\\s+"} and p["content"] == " " for p in parts)
        self.by_word = bool(self.suffix) and known and self._joined(_TRIED, _TRIED, [" ", "\n", " \r\n\t "], _TRIED, _TRIED)
        letters, signs = zip(*(m.groups() for m in map(_PLAIN.fullmatch, _TRIED) if m))
        signs = [*signs, "!", "\"#", ",", "-", ".", ":", "]", "_", "~~"]
        self.by_letters = self.by_word and self._joined(letters, signs, [""], [x.lower() for x in letters], signs)

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _joined(self, first: list[str], second: list[str], between: list[str], alone: list[str], behind: list[str]) -> bool:
        """Whether each of ``first``, a gap and each of ``second`` come out as their counterparts ``alone`` and ``behind`` do one by one."""
        a, b = self._whole(list(alone)), self._whole(list(behind))
        return all(got == x + y for gap in between for k, x in enumerate(a) for got, y in zip(self._whole([first[k] + gap + s for s in second]), b))

    def _words(self, words: list[str]) -> dict[str, bytes]:
        """Plain words are put together from letters in lower case and signs, each of which is encoded once.

        New letters go in long lines, which are cut after the tokens that end a pre-token.
        """
        known, out, cut, rest = self.known, {}, {}, []
        for w in words:
            if m := self.by_letters and _PLAIN.fullmatch(w):
                cut[w] = m[1].lower(), m[2]
            else:
                rest.append(w)
        parts: dict[str, bytes] = {}
        letters = list({a for a, _ in cut.values()}.difference(known))
        for lo in range(0, len(letters), 2000):
            group = letters[lo : lo + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(group)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(group):
                parts |= dict(zip(group, self._whole(group)))
                continue
            data, cuts = ids.tobytes(), (4 * stops).tolist()
            parts |= {w: data[a:b] for w, a, b in zip(group, [0, *cuts], cuts)}
        signs = list({b for _, b in cut.values()}.difference(known))
        parts |= dict(zip(signs, self._whole(signs)))
        get = lambda x: known[x] if x in known else parts[x]
        out = {w: get(a) + get(b) for w, (a, b) in cut.items()}
        return parts | out | dict(zip(rest, self._whole(rest)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if not self.by_word:
            return self._whole(texts)
        out: list[bytes] = []
        for lo, hi in slices([len(t) for t in texts], 500_000):
            split = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts[lo:hi]]
            new = list(set().union(*split).difference(self.known))
            extra = self._words(new)
            if len(self.known) + len(extra) <= _MOST_WORDS:
                self.known |= extra
                get = self.known.__getitem__
            else:
                known = self.known
                get = lambda w: known.get(w) if w in known else extra[w]
            out += [b"".join(map(get, ws)) for ws in split]
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and vocabulary file."""
    return Encoder(path)
