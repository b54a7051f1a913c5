"""Token ids of whole texts with a public tokenizer, by distinct words.

A byte-pair tokenizer splits a text before every space that follows a non-space, so a text's ids
are its words' ids end to end. Words repeat, across documents as well, so a bounded cache in each
Python worker holds the ids of recent words as little-endian bytes and the library only sees new ones.
Where the tokenizer's added tokens stand literally in a text, the library cuts there first, and so do we.
"""

from __future__ import annotations

import re

from quotaloom.llm.worker import keep

#: Words a worker remembers: one generation fills, the one before it serves, the one before that goes.
CACHE_WORDS = 600_000
#: A longer word is encoded but not remembered.
CACHE_CHARS = 64
#: Words encoded in one call.
JOINED = 1000
#: Texts of about so many characters are encoded at a time.
CHUNK_CHARS = 4_000_000

#: Stands between words where a text is cut; texts that hold it are left to the library.
PART = "\0"

#: Parts of words that a byte-level worker remembers, the latest used ones.
KNOWN_PARTS = 500_000

_before_space = re.compile(r"(?<=\S)(?= )")
_space_run = re.compile(r"\s ")
_two_spaces = re.compile(r"\s\s")
# A run of white space stays with what follows it, as its last character goes there; a lone line end is a token.
_edges = re.compile(r"(?<=\S)(?=[ \n])|(?<=\S\n)(?=\S)")
#: A run of letters, with its space, and what follows it; both are cut there by the byte-level pattern, which looks behind nowhere.
_LETTERS = r"(?s)^(?P<letters> ?[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<rest>[\n-@\[-`{-~].*)?$"
#: Two characters that Python or the library takes for white space.
_SPACE_RUN = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{180E}\x{2000}-\x{200B}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]{2}"
_SPACED = r"^ [!-~À-ÿ]+$"
_BARE = r"^[!-~À-ÿ]+$"


class KnownParts:
    """Ids of parts of words in Arrow columns, those used last first."""

    def __init__(self, most: int):
        import pyarrow as pa

        self.most = most
        self.parts, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def ids_of(self, parts, encode):
        """Ids (large binary) of distinct ``parts`` (large string); ``encode`` gives those of unknown ones."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        place = pc.index_in(parts, value_set=self.parts)
        known = place.is_valid()
        unseen = parts.filter(pc.invert(known))
        ids = pa.concat_arrays([self.ids, encode(unseen)])
        at = pc.fill_null(place, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        hit = known.to_numpy(zero_copy_only=False)
        at[~hit] = len(self.parts) + np.arange(len(unseen))
        out = ids.take(pa.array(at))
        short = pc.less_equal(pc.utf8_length(parts), CACHE_CHARS)
        unused = np.ones(len(self.parts), bool)
        unused[at[hit]] = False
        unused = pa.array(unused)
        self.parts = pa.concat_arrays([parts.filter(short), self.parts.filter(unused)])
        self.ids = pa.concat_arrays([out.filter(short), self.ids.filter(unused)])
        if len(self.parts) > self.most:  # copied, as a slice would hold all of it
            first = pa.array(np.arange(self.most))
            self.parts, self.ids = self.parts.take(first), self.ids.take(first)
        return out


class WordEncoder:
    """ids(text) -> little-endian unsigned 32-bit ids as bytes; equal to the library's on the whole text."""

    def __init__(self, tokenizer_json: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = self.tokenizer.get_added_tokens_decoder()
        #: Ids of the added tokens, by their literals.
        self.added = {t.content: int(i).to_bytes(4, "little") for i, t in added.items()}
        self._literals = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        # Tokens that look at what is around them, or at the normalized text, are left to the library.
        odd = lambda t: t.normalized or t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content)
        self.whole = any(map(odd, added.values()))
        # With white space dropped between words, "word" and " word" have the same ids.
        alone = lambda w: self.tokenizer.encode(w, add_special_tokens=False).ids
        self.spaceless = all(alone(w) == alone("a") for w in (" a", "  a", "\na"))
        # Letters and the mark after them are separate words to the library's pattern; some fold case first.
        self.begins = self.columns = self.newline = None
        self.marks = ".," if self._encode(["a.", "a,"]) == self._join([["a", "."], ["a", ","]]) else ""
        self.begins = None if self.spaceless else self._begins()
        self.caseless = self._encode(["aB", "AB"]) == self._encode(["ab"]) * 2
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        if self._byte_level():
            self.columns = KnownParts(KNOWN_PARTS)
            newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
            self.newline = newline[0] if len(newline) == 1 else None

    def _byte_level(self) -> bool:
        """Whether words are cut by the library's byte-level pattern alone, which parts letters, digits, marks and white space."""
        import json

        rule = self.tokenizer.pre_tokenizer
        cut = json.loads(rule.__getstate__()) if rule else {}
        plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
        return bool(plain and not self.tokenizer.normalizer and not any(a[:1].isalpha() for a in self.added))

    def _begins(self):
        """By id, whether a token starts with the byte of a space, as the byte-level alphabet writes it."""
        import numpy as np

        vocabulary = self.tokenizer.get_vocab()
        out = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        out[[i for t, i in vocabulary.items() if t[:1] == "\u0120" and t not in self.added]] = True
        return out

    def _join(self, rows: list[list[str]]) -> list[bytes]:
        return [b"".join(self._encode(r)) for r in rows]

    def _simpler(self, word: str) -> tuple[str, str]:
        """(word, mark) whose ids end to end are those of ``word``."""
        mark = ""
        if len(word) > 1 and word[-1] in self.marks and word[-2].lower()[-1].isalpha():
            word, mark = word[:-1], word[-1]
        if self.caseless and word.isascii() and not self._holds_added(word.lower()):
            word = word.lower()
        return word, mark

    def _holds_added(self, text: str) -> bool:
        return any(a in text for a in self.added)

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Ordinary words go to the library many at a time, and places in the text part the ids."""
        import numpy as np

        out: list[bytes] = [b""] * len(words)
        if self.spaceless:
            plain = [i for i, w in enumerate(words) if w.isprintable()]
        else:  # a word that starts with its own space
            plain = [i for i, w in enumerate(words) if w[:1] == " " and w.isprintable() and " " not in w[1:]]
        gap = " " if self.spaceless else ""
        for at in range(0, len(plain), JOINED):
            part = plain[at : at + JOINED]
            texts = [words[i] for i in part]
            first = None
            if self.begins is not None:  # every word starts with its only space: no places needed
                ids = np.array(self.tokenizer.encode_batch_fast([gap.join(texts)], add_special_tokens=False)[0].ids, "<u4")
                first = np.flatnonzero(self.begins[ids])
            if first is None or len(first) != len(part):
                got = self.tokenizer.encode(gap.join(texts), add_special_tokens=False)
                ids = np.array(got.ids, "<u4")
                starts = np.fromiter((o[0] for o in got.offsets), np.int64, len(got.ids))
                sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(gap)
                first = np.searchsorted(starts, np.cumsum(sizes) - sizes)
            cuts, data = [*(4 * first).tolist(), 4 * len(ids)], ids.tobytes()
            for k, i in enumerate(part):
                out[i] = data[cuts[k] : cuts[k + 1]]
        ordinary = set(plain)
        rest = [i for i in range(len(words)) if i not in ordinary]
        for i, e in zip(rest, self.tokenizer.encode_batch([words[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out

    def _encode_column(self, words):
        """Ids (large binary) of a large string column of distinct words; ordinary ones go to the library many at a time."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        spaced = pc.match_substring_regex(words, _SPACED).to_numpy(zero_copy_only=False)
        bare = pc.match_substring_regex(words, _BARE).to_numpy(zero_copy_only=False) & (self.newline is not None)
        order, columns = [], []
        for kind, chosen in ((0, spaced), (1, bare), (2, ~(spaced | bare))):
            places = np.flatnonzero(chosen)
            column = words.take(pa.array(places))
            ids, sizes = [], []
            for at in range(0, len(column), JOINED):
                part = column.slice(at, JOINED)
                got = cut = None
                if kind < 2:
                    # A word with its space begins with the only token that does; a line's end between other characters is a token.
                    text = ("\n" * kind).join(part.to_pylist())
                    got = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
                    ends = got == self.newline if kind else None
                    first = np.flatnonzero(self.begins[got]) if not kind else np.concatenate([[0], np.flatnonzero(ends) + 1])
                    if len(first) == len(part):
                        cut = np.diff(first, append=len(got) + kind) - kind
                        got = got[~ends] if kind else got
                if cut is None:
                    each = self._encode(part.to_pylist())
                    got, cut = np.frombuffer(b"".join(each), "<u4"), np.fromiter(map(len, each), np.int64, len(each)) // 4
                ids.append(got)
                sizes.append(cut)
            if ids:
                offsets = np.concatenate([[0], np.cumsum(4 * np.concatenate(sizes))]).astype(np.int64)
                data = [None, pa.py_buffer(offsets), pa.py_buffer(np.concatenate(ids))]
                order.append(places)
                columns.append(pa.Array.from_buffers(pa.large_binary(), len(places), data))
        if not columns:
            return pa.array([], pa.large_binary())
        return pa.concat_arrays(columns).take(pa.array(np.argsort(np.concatenate(order))))

    def split(self, text: str) -> list[str]:
        """Words and literals of added tokens."""
        if not self._holds_added(text):
            return self._words(text)
        parts = self._literals.split(text)  # every other one is a literal
        return [w for k, part in enumerate(parts) for w in ([part] if k % 2 else self._words(part))]

    def _words(self, text: str) -> list[str]:
        if self.spaceless:
            return text.replace("\n", " ").split(" ")
        if self.columns:
            return self._parted(text).split(PART)
        if _space_run.search(text):
            return _before_space.split(text)
        words = text.split(" ")
        return [words[0], *[" " + w for w in words[1:]]]

    def ids(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        import numpy as np

        if self.whole:
            return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        if any(PART in t for t in texts):
            whole = lambda t: np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            rest = iter(self.ids([t for t in texts if PART not in t]))
            return [whole(t) if PART in t else next(rest) for t in texts]
        import pyarrow as pa
        import pyarrow.compute as pc

        # Distinct words are found, and the ids of all words put together, a column at a time.
        rows = pc.split_pattern(self._all_parted(texts), PART)
        coded = pc.dictionary_encode(rows.flatten())
        if self.columns:
            return self._put_together(rows, coded)
        ids = self._ids_of_words(coded.dictionary.to_pylist())
        data, code = np.frombuffer(b"".join(ids), "<u4"), coded.indices.to_numpy(zero_copy_only=False)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        n = size[code]
        ends = np.concatenate([[0], np.cumsum(n)])
        place = np.repeat((np.cumsum(size) - size)[code] - ends[:-1], n)
        place += np.arange(len(place))
        out, cuts = data[place].tobytes(), (4 * ends[rows.offsets.to_numpy(zero_copy_only=False)]).tolist()
        return [out[a:b] for a, b in zip(cuts, cuts[1:])]

    def _all_parted(self, texts: list[str]):
        """A column of ``_parted`` texts; byte-level texts without runs of white space or added tokens are cut in Arrow."""
        import pyarrow as pa
        import pyarrow.compute as pc

        if not self.columns:
            return pa.array([self._parted(t) for t in texts], pa.large_string())
        texts = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(texts, _SPACE_RUN)
        for a in self.added:
            odd = pc.or_(odd, pc.match_substring(texts, a))
        plain = pc.replace_substring(pc.replace_substring(texts, "\n", f"{PART}\n{PART}"), " ", f"{PART} ")
        if not pc.any(odd).as_py():
            return plain
        others = pa.array([self._parted(t) for t in texts.filter(odd).to_pylist()], pa.large_string())
        return pc.replace_with_mask(plain, odd, others)

    def _parted(self, text: str) -> str:
        """The words of ``split`` with PART between them, for a text that holds none itself."""
        if self._holds_added(text):
            return PART.join(self.split(text))
        if self.columns:
            if _two_spaces.search(text):
                return PART.join(_edges.split(text))
            return text.replace("\n", f"{PART}\n{PART}").replace(" ", f"{PART} ")
        if self.spaceless:
            return text.replace("\n", PART).replace(" ", PART)
        if _space_run.search(text):
            return PART.join(_before_space.split(text))
        return text.replace(" ", PART + " ")

    def _put_together(self, rows, coded) -> list[bytes]:
        """Ids of each text, from the words of all: a word's letters and what follows them are looked up apart."""
        import pyarrow as pa
        import pyarrow.compute as pc

        words = coded.dictionary
        cut = pc.extract_regex(words, _LETTERS)
        letters = pc.coalesce(pc.struct_field(cut, "letters"), words)
        rest = pc.coalesce(pc.struct_field(cut, "rest"), pa.scalar("", pa.large_string()))
        both = pc.dictionary_encode(pa.concat_arrays([letters, rest]))
        ids = self.columns.ids_of(both.dictionary, self._encode_column).take(both.indices)
        of_words = pc.binary_join_element_wise(ids.slice(0, len(words)), ids.slice(len(words)), pa.scalar(b"", pa.large_binary()))
        of_texts = of_words.take(coded.indices)
        _, offsets, data = of_texts.buffers()
        ends = memoryview(offsets).cast("q")
        cuts, data = [ends[k] for k in rows.offsets.to_pylist()], memoryview(data or b"")
        return [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]

    def _ids_of_words(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, from memory or the library."""
        new, old = self.new, self.old
        if len(new) > CACHE_WORDS:
            new, old = {}, new
        out: list[bytes | None] = list(map(new.get, words))
        unseen: list[int] = []
        for k, ids in enumerate(out):
            if ids is None:
                w = words[k]
                ids = self.added.get(w)
                if ids is None:
                    ids = old.get(w)
                    if ids is None:
                        unseen.append(k)
                        continue
                    new[w] = ids
                out[k] = ids
        parts = [self._simpler(words[k]) for k in unseen]
        known = {}
        for w in {x for part in parts for x in part}:
            known[w] = new.get(w) or old.get(w) or (b"" if not w else None)
        todo = [w for w, ids in known.items() if ids is None]
        known.update(zip(todo, self._encode(todo), strict=True))
        for k, (word, mark) in zip(unseen, parts, strict=True):
            w, ids = words[k], known[word]
            if len(w) <= CACHE_CHARS:
                new[word] = ids
            if mark or w is not word:
                ids += known[mark]
                if len(w) <= CACHE_CHARS:
                    new[w] = ids
            out[k] = ids
        self.new, self.old = new, old
        return out


def encoder(tokenizer_json: str) -> WordEncoder:
    """The worker's encoder for this tokenizer; it outlives a task where Spark reuses workers."""
    return keep(("encoder", hash(tokenizer_json)), lambda: WordEncoder(tokenizer_json))


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS):
    """(first, last) ranges of about ``limit`` characters each."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= limit:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def tokenizer_path(name: str) -> str:
    """Where the machine keeps the public tokenizer ``name``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_text_file(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
