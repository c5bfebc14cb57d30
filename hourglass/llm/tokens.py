"""Token ids of whole texts with the tokenizers library, inside Spark tasks.

Texts are cut before every blank or line feed that follows a character other
than white space.  The pre-tokenizers served here always cut there (or drop
the white space), and no added token holds white space, so the ids of a text
are the ids of its pieces in order.  Cutting, and finding the distinct pieces of a chunk
of texts, is done in Arrow; a bounded table per worker holds the ids of
distinct pieces.  New pieces of printable ASCII go to the library's merge model
joined to long words, where no token of the vocabulary reaches over a cut of
the pre-tokenizer; the lengths of the tokens tell where each piece ends.  Other new
pieces are split by the pre-tokenizer's own pattern and their parts go to the
merge model one by one; pieces holding an added token, or a character that the
pattern module and the library class differently, go to the library as a whole.
Other kinds of tokenizer get whole texts.
"""

from __future__ import annotations

import ctypes
import gc
import json
import re
from array import array
from itertools import chain, compress
from operator import attrgetter

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
MARK = "\x01"
CHUNK_BYTES = 4_000_000
JOINED = 64  # new pieces in one word of the merge model
# fixed value: the split pattern of byte-level BPE
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# a blank or line feed after any white space, or the mark itself (RE2 has no Unicode \s)
_IRREGULAR = (
    r"[\t\n\x0b\x0c\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}][ \n]|\x01"
)
_CUT = re.compile(r"(?<!\s)(?=[ \n])")
_PLAIN = re.compile(r" ?\S+")
# without the apostrophe, which byte-level patterns cut by what follows it
_JOINABLE = re.compile(r"[ \n][!-&(-~]+")
_BLANK, _FEED = chr(256 + ord(" ")), chr(256 + ord("\n"))  # their byte-level letters
_KEPT: dict[tuple, "PieceTable"] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str, plain: bool = False) -> "PieceEncoder":
    """The worker's encoder for a vocabulary file."""
    return kept((path, plain), lambda: PieceEncoder(path, plain))


def kept(key: tuple, make):
    """The worker's table under ``key``, kept between tasks.  A worker holds one
    table at a time; another key takes its place."""
    if key not in _KEPT:
        release()
        _KEPT[key] = make()
    return _KEPT[key]


def release() -> None:
    """Drop the worker's table (tasks that need their memory otherwise)."""
    _KEPT.clear()


def trim() -> None:
    """Give freed memory back to the system where the C library can (workers
    share their executor's memory limit with its JVM)."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        return


def ragged(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Positions ``begin[i] .. begin[i] + count[i] - 1`` of all i in order."""
    upto = np.cumsum(count)
    total = int(upto[-1]) if len(upto) else 0
    return np.arange(total) + np.repeat(begin - (upto - count), count)


def cut(texts):
    """``(pieces, counts)``: the pieces of an Arrow array of non-null texts, one
    after the other, and how many each text has (empty pieces may occur)."""
    import pyarrow as pa
    import pyarrow.compute as pc

    odd = np.flatnonzero(pc.match_substring_regex(texts, _IRREGULAR).to_numpy(zero_copy_only=False))
    marked = pc.replace_substring(pc.replace_substring(texts, "\n", MARK + "\n"), " ", MARK + " ")
    lists = pc.split_pattern(marked, MARK)
    pieces, counts = lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    if not len(odd):
        return pieces, counts
    begin = np.cumsum(counts) - counts
    own = [_CUT.split(t) for t in texts.take(pa.array(odd)).to_pylist()]
    n = np.array([len(p) for p in own], dtype=np.int64)
    begin[odd], counts[odd] = len(pieces) + np.cumsum(n) - n, n
    both = pa.concat_arrays([pieces, pa.array([p for ps in own for p in ps], pieces.type)])
    return both.take(pa.array(ragged(begin, counts))), counts


class PieceTable:
    """Bounded table of what is known about distinct pieces.  When it is full
    the less used half is forgotten."""

    def __init__(self, max_pieces: int = 450_000, max_bytes: int = 24_000_000):
        self.max_pieces, self.max_bytes = max_pieces, max_bytes
        self.table: dict[str, int] = {}
        self.hits = np.zeros(0, dtype=np.int64)
        self.bytes = 0

    def learn(self, pieces: list[str]) -> list[str]:
        """Append what belongs to new distinct ``pieces``; returns them in the
        order they were appended."""
        raise NotImplementedError

    def keep(self, rows: np.ndarray) -> None:
        """Reduce what was appended to these ``rows``, in this order."""
        raise NotImplementedError

    def _forget(self) -> None:
        names = list(self.table)  # in the order of the rows
        rows = np.sort(np.argsort(-self.hits, kind="stable")[: min(len(names), self.max_pieces) // 2])
        size = np.cumsum([len(names[r]) for r in rows])
        rows = rows[: int(np.searchsorted(size, self.max_bytes // 2, side="right"))]
        self.keep(rows)
        self.table = {names[r]: i for i, r in enumerate(rows.tolist())}
        self.hits = self.hits[rows] // 2
        self.bytes = int(size[len(rows) - 1]) if len(rows) else 0

    def rows(self, pieces) -> np.ndarray:
        """Row of the table for every piece of an Arrow array.  Rows hold until
        the next call."""
        if len(self.table) > self.max_pieces or self.bytes > self.max_bytes:
            self._forget()
        coded = pieces.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.table.get, names))
        if None in found:  # only new pieces are looked up again
            at = [i for i, f in enumerate(found) if f is None]
            fresh = [names[i] for i in at]
            first = len(self.table)
            collects = gc.isenabled()
            gc.disable()  # many small lists, no cycles
            try:
                self.table.update(zip(self.learn(fresh), range(first, first + len(fresh))))
            finally:
                if collects:
                    gc.enable()
            self.hits = np.concatenate([self.hits, np.zeros(len(fresh), dtype=np.int64)])
            self.bytes += sum(map(len, fresh))
            for i, row in zip(at, map(self.table.get, fresh)):
                found[i] = row
        found = np.array(found, dtype=np.int64)
        where = coded.indices.to_numpy()
        if len(found):
            self.hits[found] += np.bincount(where, minlength=len(found))
        return found[where]


class PieceEncoder(PieceTable):
    """Ids of a tokenizers file.  ``plain``: the strings of added tokens are
    ordinary text; otherwise they are found like the library does."""

    def __init__(self, path: str, plain: bool = False, max_pieces: int = 450_000, max_bytes: int = 24_000_000):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        added = [] if plain else conf["added_tokens"]
        self.added = [a["content"] for a in added]
        pattern, self.blanks = _pattern(conf)
        if pattern is None or any(re.search(r"\s", a["content"]) or a["lstrip"] or a["rstrip"] for a in added):
            self.blanks, self.split = None, None  # whole texts
        else:
            self.split = regex.compile(pattern if self.blanks else pattern + r"|\n")
        self.letters = _byte_letters()
        self.nul, self.hold = chr(self.letters[0]), "".join(chr(self.letters[b]) for b in "\uffff".encode())
        self.letters[0] = 0  # keeps parts apart
        self.known: set[str] = set()
        self.strange = {"\uffff"}  # stands for NUL while parts are mapped
        super().__init__(max_pieces, max_bytes)
        self.flat, self.begin, self.count = array("I"), array("q"), array("q")
        self.width = _widths(conf, self.split) if self.blanks else None
        self._no_parts()

    def _no_parts(self) -> None:
        self.parts: dict[str, int] = {}
        self.part_ids, self.part_begin, self.part_count = array("I"), array("q"), array("q")

    def keep(self, rows: np.ndarray) -> None:
        begin, count = np.frombuffer(self.begin, dtype=np.int64)[rows], np.frombuffer(self.count, dtype=np.int64)[rows]
        ids = np.frombuffer(self.flat, dtype=np.uint32)[ragged(begin, count)]
        self.flat, self.begin, self.count = array("I"), array("q"), array("q")
        self._append(ids, count)

    def _check(self, chars: set[str]) -> None:
        """Compare the pattern's cuts with the library's around new characters."""
        for c in chars - self.known:
            for probe in ("a" + c + "a", "1" + c + "1", "!" + c + "!", " " + c, c + "'s"):
                own = [m.span() for m in self.split.finditer(probe) if m.group() != "\n"]
                cuts = self.tokenizer.pre_tokenizer.pre_tokenize_str(probe)
                if own != [s for _, s in cuts] and c != "\n":
                    self.strange.add(c)
        self.known |= chars

    def learn(self, pieces: list[str]) -> list[str]:
        order, ids, count = self.coded(pieces)
        self._append(ids, count)
        return order

    def coded(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The pieces in another order, their ids one after the other, and counts."""
        if self.split is None:
            return pieces, *self._whole(pieces)
        whole = []
        if any(a in "\n".join(pieces) for a in self.added):
            whole = [p for p in pieces if any(a in p for a in self.added)]
            pieces = [p for p in pieces if not any(a in p for a in self.added)]
        texts = pieces
        if self.tokenizer.normalizer is not None:
            # single blanks stay apart; pieces with other white space go one by one
            normal = self.tokenizer.normalizer.normalize_str
            texts = normal(" ".join(pieces)).split(" ")
            if len(texts) != len(pieces):
                texts = list(map(normal, pieces))
        chars = set("".join(texts))
        self._check(chars)
        odd = self.strange & chars
        if odd:
            whole += [p for p, t in zip(pieces, texts) if not odd.isdisjoint(t)]
            both = [(p, t) for p, t in zip(pieces, texts) if odd.isdisjoint(t)]
            pieces, texts = [p for p, _ in both], [t for _, t in both]
        joined: list[str] = []
        if self.width is not None:
            fits = list(map(bool, map(_JOINABLE.fullmatch, pieces)))
            joined = list(compress(pieces, fits))
            pieces = texts = [p for p, ok in zip(pieces, fits) if not ok]
        pieces, ids, count = self._split(pieces, texts)
        if joined:
            more, n = self._joined(joined)
            pieces, ids, count = joined + pieces, np.concatenate([more, ids]), np.concatenate([n, count])
        if whole:
            more, n = self._whole(whole)
            ids, count = np.concatenate([ids, more]), np.concatenate([count, n])
        return pieces + whole, ids, count

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of printable pieces, many to a word of the merge model."""
        words = ["".join(pieces[a : a + JOINED]).replace(" ", _BLANK).replace("\n", _FEED) for a in range(0, len(pieces), JOINED)]
        tokens = chain.from_iterable(map(self.tokenizer.model.tokenize, words))
        ids = np.fromiter(map(attrgetter("id"), tokens), dtype=np.uint32)
        upto = np.cumsum(self.width[ids])
        at = np.searchsorted(upto, np.cumsum(np.array(list(map(len, pieces)), dtype=np.int64))) + 1
        return ids, np.diff(at, prepend=0)

    def _split(self, pieces: list[str], texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The pieces in another order, their ids and counts by the pattern's parts."""
        if not pieces:
            return [], np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        if len(self.parts) > self.max_pieces // 2:
            self._no_parts()
        # many pieces are split in one call, kept apart by line feeds; those with white space within go alone
        plain = list(map(bool, map(_PLAIN.fullmatch, texts)))
        easy = [t for t, ok in zip(texts, plain) if ok]
        rest = [t for t, ok in zip(texts, plain) if not ok]
        parts = self.split.findall("\n".join(easy)) + ["\n"] if easy else []
        rows = self._part_rows(parts)
        ends = np.flatnonzero(rows == self.parts.get("\n", -1))
        per = np.diff(np.concatenate([[-1], ends])) - 1
        rows = np.delete(rows, ends)
        if rest:
            alone = list(map(self.split.findall, rest))
            rows = np.concatenate([rows, self._part_rows([x for ps in alone for x in ps])])
            per = np.concatenate([per, np.array(list(map(len, alone)), dtype=np.int64)])
        begin, count = (np.frombuffer(x, dtype=np.int64)[rows] for x in (self.part_begin, self.part_count))
        ids = np.frombuffer(self.part_ids, dtype=np.uint32)[ragged(begin, count)]
        upto = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(per)]).astype(np.int64)]
        count = np.diff(upto)
        order = [p for p, ok in zip(pieces, plain) if ok] + [p for p, ok in zip(pieces, plain) if not ok]
        return order, ids, count

    def _part_rows(self, parts: list[str]) -> np.ndarray:
        """Rows of pre-token parts; new ones go through the merge model."""
        get = self.parts.get
        found = list(map(get, parts))
        if None in found:
            fresh = list(dict.fromkeys(p for p, at in zip(parts, found) if at is None))
            # the byte-level letters of all parts at once, kept apart by a letter of no byte
            raw = "\0".join(p.replace("\0", "\uffff") for p in fresh).encode()
            mapped = self.letters[np.frombuffer(raw, dtype=np.uint8)].tobytes().decode("utf-32-le")
            mapped = mapped.replace(self.hold, self.nul).split("\0")
            tokenize, number = self.tokenizer.model.tokenize, attrgetter("id")
            ids = [list(map(number, tokenize(m))) for m in mapped]
            count = np.array(list(map(len, ids)), dtype=np.int64)
            self.part_begin.frombytes((len(self.part_ids) + np.cumsum(count) - count).tobytes())
            self.part_count.frombytes(count.tobytes())
            self.part_ids.extend(chain.from_iterable(ids))
            self.parts.update(zip(fresh, range(len(self.parts), len(self.parts) + len(fresh))))
            found = list(map(get, parts))
        return np.array(found, dtype=np.int64)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts by the library's own call."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(ids)), dtype=np.uint32), np.array(list(map(len, ids)), dtype=np.int64)

    def _append(self, ids: np.ndarray, count: np.ndarray) -> None:
        self.begin.frombytes((len(self.flat) + np.cumsum(count) - count).astype(np.int64).tobytes())
        self.count.frombytes(count.astype(np.int64).tobytes())
        self.flat.frombytes(ids.astype(np.uint32).tobytes())

    def pieces(self, texts):
        """``(pieces, counts)`` of non-null texts as this vocabulary needs them."""
        import pyarrow.compute as pc

        if self.split is None:
            return texts, np.ones(len(texts), dtype=np.int64)
        if self.blanks:
            return cut(texts)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        return lists.flatten(), np.diff(lists.offsets.to_numpy()).astype(np.int64)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (Arrow array, no nulls), concatenated (uint32), and
        the count per text."""
        pieces, per_text = self.pieces(texts)
        which = self.rows(pieces)
        count = np.frombuffer(self.count, dtype=np.int64)[which]
        ids = np.frombuffer(self.flat, dtype=np.uint32)[ragged(np.frombuffer(self.begin, dtype=np.int64)[which], count)]
        ends = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(per_text)])]
        return ids, np.diff(ends)


def _pattern(conf: dict):
    """Split pattern of a tokenizer file, and whether it keeps white space;
    None where the file has another kind of pre-tokenizer."""
    pre = conf.get("pre_tokenizer") or {}
    if pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and not conf.get("normalizer"):
        return BYTE_LEVEL, True
    steps = pre.get("pretokenizers", [])
    if [s["type"] for s in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"] and not steps[1]["add_prefix_space"]:
        first = steps[0]
        if first["invert"] and first["behavior"] == "Removed" and "Regex" in first["pattern"]:
            return first["pattern"]["Regex"], False
    return None, None


def _widths(conf: dict, split) -> np.ndarray | None:
    """Bytes of every id of a byte-level vocabulary; None where printable pieces
    may not be merged as one word: a token of ASCII bytes reaches over a cut of
    the pattern, or the model treats words as such."""
    model = conf["model"]
    as_words = ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")
    if model.get("type") != "BPE" or any(model.get(x) for x in as_words):
        return None
    raw = {chr(x): chr(b) for b, x in enumerate(_byte_letters().tolist()) if b < 128}
    if any(x not in model["vocab"] for x in raw):  # unknown letters would be dropped
        return None
    width = np.zeros(max(model["vocab"].values()) + 1, dtype=np.int64)
    for token, i in model["vocab"].items():
        width[i] = len(token)
        if all(x in raw for x in token) and "'" not in token:
            text = "".join(raw[x] for x in token)
            if split.findall(text) != [text]:
                return None
    return width


def _byte_letters() -> np.ndarray:
    """Byte-level alphabet (code point of every byte): printable bytes stand for
    themselves, the others, in order, for the characters from 256 on."""
    letters = np.arange(256, dtype=np.uint32)
    hidden = np.r_[0 : ord("!"), ord("~") + 1 : 0xA1, 0xAD]
    letters[hidden] = 256 + np.arange(len(hidden))
    return letters


def chunks(texts, max_bytes: int = CHUNK_BYTES):
    """(first, last) ranges of an Arrow array of texts of bounded total size
    (a longer text has a range to itself)."""
    import pyarrow.compute as pc

    a, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > a and size + n > max_bytes:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


def encode_with_end(texts, path: str, end_id: int):
    """Yields the ids (uint32) of each text of an Arrow array (null: empty)
    with ``end_id`` appended, in order."""
    import pyarrow.compute as pc

    enc = encoder(path)
    texts = pc.fill_null(texts, "")
    for a, b in chunks(texts):
        ids, counts = enc.encode(texts[a:b])
        ends = np.cumsum(counts)
        whole = np.insert(ids, ends, np.uint32(end_id))
        at = 0
        for n in (counts + 1).tolist():
            yield whole[at : at + n]
            at += n
        del whole, ids
        trim()
