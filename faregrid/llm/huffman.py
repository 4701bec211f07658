"""Token ids as canonical, length-limited Huffman blocks.

File format: three Parquet tables below one folder, which are all that a reader needs.

``blocks``: whole documents in ascending ``doc_id`` order; each is decoded by itself:

    part, block      place of the block in the global order (parts by bounds of ``doc_id``)
    first            ids in earlier blocks of the part
    doc_ids, counts  the documents and how many ids each has
    payload          the code words, most significant bit first; documents begin at bytes
    stride           how many ids lie between checkpoints
    checkpoints      bit offset of every ``stride``-th id of each document in the payload

``book``: the code book, one length (``bits``) per ``id`` in use; canonical order makes the
code words follow from the lengths. ``parts``: the ids in front (``before``) of each ``part``.

All stretches between checkpoints of a block are decoded side by side with a table of all
``LIMIT``-bit prefixes.

Defined results: a null or empty text has only the end id; strings of added tokens in a text
get the id of the token, as the library gives it; rows with equal ``doc_id`` keep their own
ids and stand next to each other, in the order of a checksum of these and of their code
words; a null ``doc_id`` sorts first; ``doc_id`` may be of any type that can be ordered; an
empty table gives an empty file set.
"""

from __future__ import annotations

import bisect
import heapq
import itertools
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from faregrid.llm.ship import ship
from faregrid.session import scratch_path

END_ID = 2
LIMIT = 16
STRIDE = 256
BLOCK_IDS = 1 << 16
PART_IDS = 1 << 22
KNOWN_CHUNKS = 500_000
TOGETHER = 256
MARKS = ",.;:!?"
OLD_LETTERS = "\u0530"  # letters and digits below are so for the tables of any library
ENCODED_BYTES = 6 << 20
_SPACE = pa.scalar(" ", pa.large_string())
DECODED_BYTES = 1 << 20

_SAFE = re.compile(r"(?<=\S)(?= )")
_BLANK_BLANK = re.compile(r"\s (?:\s|\Z)")
_BEFORE_BLANK = re.compile(r" (?:\s|\Z)")  # needed by the former, and found faster


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    # tasks are the parallelism; threads of the library would compete with them
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def id_type(path: str) -> np.dtype:
    """The narrower of 16 and 32 bits that holds all ids."""
    return np.dtype("<u2" if _tokenizer(path).get_vocab_size() < 1 << 16 else "<u4")


@lru_cache(maxsize=2)
def _space_first(path: str) -> np.ndarray:
    """Per id, whether its token begins with a space, as the byte level writes it."""
    tokenizer = _tokenizer(path)
    vocabulary = tokenizer.get_vocab()
    found = np.zeros(max(vocabulary.values(), default=-1) + 1, dtype=bool)
    found[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
    return found


class _Encoder:
    """Encodes text word by word and remembers words seen before.

    Arrow splits the texts of a column at spaces and in front of line ends, and numbers equal
    words; ``words`` has the number of " word" (or of the word, if a line end is in front), and
    ``raw`` that of other chunks. The byte-level pre-splitting never joins at a space between
    two non-blanks, and takes a line end by itself next to a non-blank, so ids of words put
    together are the ids of the text. Words that are odd, because they are empty or have another
    blank at their ends, and three line ends in a row are cut before a blank that follows a
    non-blank only. A text with an added token is cut by ``chunks``: a chunk ends before a space
    that follows a non-blank or is followed by one, after non-blanks only if the text has a space
    between blanks.

    The library cuts a text at the strings of added tokens before anything else, so they are
    chunks of their own, and what lies between two of them is cut like a text. A text is one
    chunk where an added token takes blanks or neighbours into account.

    New chunks go to the tokenizer many at a time. Chunks of a space and non-blanks follow one
    another at once, as in a text: the first token of each is the only one that begins with a
    space. Others have a tab between them: a tab next to a non-blank, or in front of a space and
    a non-blank, is always a match of its own.
    A mark of ``MARKS`` behind a letter or digit at the end of a chunk is a match of its own, too,
    and one id, so the ids of a word tell those of the word with a mark and the other way round.

    Beyond ``KNOWN_CHUNKS`` the more frequent half of them is kept, of those seen twice.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.kind = id_type(path)
        self.space_first = _space_first(path)
        (self.tab,) = self.tokenizer.encode("\t", add_special_tokens=False).ids
        (self.line_end,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        added = list(self.tokenizer.get_added_tokens_decoder().values())
        self.added = sorted((t.content for t in added), key=len, reverse=True)
        longest_first = "|".join(map(re.escape, self.added))
        self.at_added = re.compile(f"({longest_first})") if added else None
        self.cut_at_added = not any(
            t.lstrip or t.rstrip or t.single_word or t.normalized or re.search(r"\s", t.content)
            for t in added
        )
        self.marks = {}
        for mark in MARKS if self.cut_at_added else "":
            ids = self.tokenizer.encode(mark, add_special_tokens=False).ids
            if len(ids) == 1:
                self.marks[mark] = ids[0]
        self.begin, self.size, self.hits = (np.zeros(1 << 16, dtype=np.int64) for _ in range(3))
        self.odd, self.holds, self.open = (np.zeros(1 << 16, dtype=bool) for _ in range(3))
        self.ids = np.zeros(1 << 18, dtype=self.kind)
        self._reset()

    def _reset(self) -> None:
        fresh = itertools.count().__next__
        self.words: defaultdict[str, int] = defaultdict(fresh)
        self.raw: defaultdict[str, int] = defaultdict(fresh)
        self.raw[""]  # an empty chunk has no ids
        self.by_chunk = _Chunks(self._number)
        self.seen_words, self.seen_raw, self.held = 0, 1, 0
        self.hits[:] = 0
        self.odd[:] = self.holds[:] = self.open[:] = False

    def chunks(self, text: str) -> list[str]:
        if not any(content in text for content in self.added):
            return self._chunks(text)
        if not self.cut_at_added:
            return [text]
        pieces = self.at_added.split(text)
        return [
            chunk
            for i, piece in enumerate(pieces)
            if piece
            for chunk in ([piece] if i % 2 else self._chunks(piece))
        ]

    def _chunks(self, text: str) -> list[str]:
        if "\0" in text or (_BEFORE_BLANK.search(text) and _BLANK_BLANK.search(text)):
            return [c for c in _SAFE.split(text) if c]
        found = text.replace(" ", "\0 ").split("\0")
        return found if found[0] else found[1:]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        ids, ends = self.encode_column(pa.array(texts, pa.large_string()))
        raw, width = ids.tobytes(), self.kind.itemsize
        return [raw[a * width : b * width] for a, b in itertools.pairwise([0, *ends.tolist()])]

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts (null: empty) one after another, and where those of each text end."""
        if len(self.words) + len(self.raw) > KNOWN_CHUNKS:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.cut_at_added:
            numbers, last, slow = self._by_words(texts)
        else:
            numbers, last = np.zeros(0, dtype=np.int64), np.zeros(len(texts) + 1, dtype=np.int64)
            slow = np.ones(len(texts), dtype=bool)
        if slow.any():
            parts = [self.chunks(t) for t in texts.filter(pa.array(slow)).to_pylist()]
            counts = np.diff(last)
            fast = numbers[np.repeat(~slow, counts)]
            counts[slow] = [len(p) for p in parts]
            last = np.r_[0, np.cumsum(counts)]
            by_chunks = np.repeat(slow, counts)
            numbers = np.empty(last[-1], dtype=np.int64)
            numbers[~by_chunks] = fast
            numbers[by_chunks] = _numbers(self.by_chunk, list(itertools.chain(*parts)))
        self._learn_new()
        known = len(self.words) + len(self.raw)
        self.hits[:known] += np.bincount(numbers, minlength=known)
        ids, ends = self._gather(numbers)
        return ids, np.r_[0, ends][last[1:]]

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of all words, where those of each text end, and texts that need ``chunks``."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        last = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.dictionary_encode()
        listed = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        distinct = pc.binary_join(listed, _SPACE)[0].as_py().split(" ") if len(texts) else []
        before = len(self.words) + len(self.raw)
        of_distinct = _numbers(self.words, distinct)
        self._room()
        fresh = np.flatnonzero(of_distinct >= before).tolist()
        # what can be printed has no blank but a space, and words have no space
        holds = self._holds_added("\n".join([distinct[i] for i in fresh]))
        for i in fresh:
            word = distinct[i]
            if (holds or not word.isprintable() or not word) and self._is_odd(word):
                self.odd[of_distinct[i]] = True
                self.holds[of_distinct[i]] = self._holds_added(word)
                self.open[of_distinct[i]] = not word or word[-1].isspace()
        codes, head = coded.indices.to_numpy(), last[:-1]
        numbers = of_distinct[codes]
        slow = np.zeros(len(texts), dtype=bool)
        if self.holds[of_distinct].any():
            slow = np.add.reduceat(self.holds[numbers], head, dtype=np.int64) > 0
        line_end = self.words.get("\n", -1)
        joined = odd = None
        if self.odd[of_distinct].any() or line_end >= 0:
            # a text can be cut before a blank that follows a non-blank
            odd, line, opened = self.odd[numbers], numbers == line_end, self.open[numbers]
            opened |= line
            opened[head] &= numbers[head] != self.words.get("", -1)
            joined = np.r_[False, opened[:-1]]
            joined[head] = False
            joined[1:] &= ~(line[:-1] & ~joined[:-1] & ~line[1:] & ~odd[1:])
        # the first word of a text has nothing in front
        heads = split.values.take(pa.array(head)).to_pylist()
        numbers[head] = _numbers(self.raw, ["" if s else w for w, s in zip(heads, slow.tolist())])
        if joined is not None and (joined.any() or odd.any()):
            odd[head] = False
            first = np.flatnonzero(~joined)
            size = np.diff(np.r_[first, len(joined)])
            own = (odd[first] | (size > 1)) & ~np.repeat(slow, np.diff(last))[first]
            is_head = np.zeros(len(joined), dtype=bool)
            is_head[head] = True
            for at, n in zip(first[own].tolist(), size[own].tolist()):
                words = [distinct[i] for i in codes[at : at + n].tolist()]
                chunk = "".join([w if w[:1] == "\n" else " " + w for w in words])
                numbers[at] = self.raw[chunk[1:] if is_head[at] and words[0][:1] != "\n" else chunk]
            numbers, last = numbers[first], np.r_[0, np.cumsum(~joined)][last]
        return numbers, last, slow

    def _holds_added(self, text: str) -> bool:
        return any(content in text for content in self.added)

    def _number(self, chunk: str) -> int:
        word = chunk[1:]
        if chunk[:1] == " " and self.cut_at_added and " " not in word and not self._is_odd(word):
            if word[0] != "\n":
                return self.words[word]
        return self.raw[chunk]

    def _is_odd(self, word: str) -> bool:
        if word == "\n":
            return False
        rest = word[1:] if word[:1] == "\n" else word
        return not rest or rest[0].isspace() or rest[-1].isspace() or self._holds_added(rest)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks one after another, and where those of each chunk end."""
        size = self.size[numbers]
        ends = np.cumsum(size)
        place = np.repeat(self.begin[numbers] - ends + size, size)
        place += np.arange(len(place))
        return self.ids[place], ends

    def _store(
        self, numbers: np.ndarray | list[int], ids: np.ndarray, begin: np.ndarray, end: np.ndarray
    ) -> None:
        while self.held + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros_like(self.ids)]
        self.ids[self.held : self.held + len(ids)] = ids
        self.begin[numbers] = begin + self.held
        self.size[numbers] = end - begin
        self.held += len(ids)

    def _room(self) -> None:
        while len(self.words) + len(self.raw) > len(self.size):
            arrays = (self.begin, self.size, self.hits, self.odd, self.holds, self.open)
            self.begin, self.size, self.hits, self.odd, self.holds, self.open = (
                np.r_[a, np.zeros_like(a)] for a in arrays
            )

    def _learn_new(self) -> None:
        """Ids of what has a number since the last time and is not odd."""
        spaced, alone, joined, after_line = [], [], [], []
        new = _latest(self.words, self.seen_words)
        odd = set(np.flatnonzero(self.odd[: len(self.words) + len(self.raw)]).tolist())
        if odd:
            new = [one for one in new if one[1] not in odd]
        asked, ended, marked = self._by_marks(self.words, new)
        for one in asked:
            word, number = one
            if word.isprintable():
                spaced.append(one)
            elif word[0] == "\n":
                after_line.append((number, self.raw[word[1:]]))
            else:
                (alone if "\t" in word else joined).append((" " + word, number))
        new = _latest(self.raw, self.seen_raw)
        asked, raw_ended, raw_marked = self._by_marks(self.raw, new)
        for one in asked:
            chunk = one[0]
            rest = chunk[1:] if chunk[0] == " " else chunk
            plain = rest and not rest[0].isspace() and not rest[-1].isspace()
            plain = plain and (self.cut_at_added or not self._holds_added(chunk))
            (joined if plain and "\t" not in chunk else alone).append(one)
        self._room()
        self._learn(spaced, TOGETHER, between=" ")
        self._learn(alone, 1)
        self._learn(joined, TOGETHER)
        self._put_marks(raw_ended, raw_marked)
        if after_line:
            numbers, rest = np.asarray(after_line).T
            ids, ends = self._gather(rest)
            begin, shift = np.r_[0, ends[:-1]], np.arange(len(ends))
            ids = np.insert(ids, begin, self.line_end)
            self._store(numbers, ids, begin + shift, ends + shift + 1)
        self._put_marks(ended, marked)
        self.seen_words, self.seen_raw = len(self.words), len(self.raw)

    def _by_marks(self, known: defaultdict, new: list[tuple[str, int]]) -> tuple[list, list, list]:
        """What the library is asked for; what of this tells the ids of the same without its
        mark; what is known but for its mark."""
        asked, ended, marked = [], [], []
        marks = self.marks
        for one in new:
            chunk, number = one
            if chunk[-1] in marks and chunk[-2:-1].isalnum() and chunk[-2] < OLD_LETTERS:
                bare = known.get(chunk[:-1])
                if chunk in self.added:
                    pass
                elif bare is None:
                    ended.append((number, known[chunk[:-1]]))
                else:
                    marked.append((number, bare, marks[chunk[-1]]))
                    continue
            asked.append(one)
        return asked, ended, marked

    def _put_marks(self, ended: list[tuple], marked: list[tuple]) -> None:
        if ended:
            whole, bare = np.asarray(ended).T
            self.begin[bare], self.size[bare] = self.begin[whole], self.size[whole] - 1
        if marked:
            numbers, bare, mark = np.asarray(marked).T
            ids, ends = self._gather(bare)
            ids = np.insert(ids, ends, mark)
            ends += np.arange(1, len(ends) + 1)
            self._store(numbers, ids, np.r_[0, ends[:-1]], ends)

    def _learn(self, asked: list[tuple[str, int]], together: int, between: str = "\t") -> None:
        """Ids of chunks; with a space ``between`` them, of words behind a space each."""
        groups = [asked[i : i + together] for i in range(0, len(asked), together)]
        front = " " if between == " " else ""
        texts = [front + between.join([chunk for chunk, _ in g]) for g in groups]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for group, one in zip(groups, encoded, strict=True):
            ids = np.asarray(one.ids, dtype=self.kind)
            if front:
                begin = np.flatnonzero(self.space_first[ids])
                end = np.r_[begin[1:], len(ids)]
                if len(begin) != len(group):  # another way to write spaces
                    self._learn([(front + word, number) for word, number in group], 1)
                    continue
            else:
                cuts = np.flatnonzero(ids == self.tab) if together > 1 else np.zeros(0, int)
                begin, end = np.r_[0, cuts + 1], np.r_[cuts, len(ids)]
            if len(begin) != len(group):
                raise ValueError(f"{len(begin)} chunks found again of {len(group)}")
            self._store([number for _, number in group], ids, begin, end)

    def _forget(self) -> None:
        known = len(self.words) + len(self.raw)
        hits = np.where(self.odd[:known], 0, self.hits[:known])
        hits[0] = 0
        keep = np.flatnonzero(hits > 1)
        keep = keep[np.argsort(-hits[keep], kind="stable")][: KNOWN_CHUNKS // 2]
        hits[:] = 0
        hits[keep] = 1
        kept = [[k for k, i in each.items() if hits[i]] for each in (self.words, self.raw)]
        numbers = np.r_[_numbers(self.words, kept[0]), _numbers(self.raw, kept[1])]
        ids, ends = self._gather(numbers)
        self._reset()
        numbers = np.r_[_numbers(self.words, kept[0]), _numbers(self.raw, kept[1])]
        self._store(numbers, ids, np.r_[0, ends][:-1], ends)
        self.seen_words, self.seen_raw = len(self.words), len(self.raw)


class _Chunks(dict):
    """Numbers of chunks; the first time by a function."""

    def __init__(self, number: Callable[[str], int]):
        super().__init__()
        self.number = number

    def __missing__(self, chunk: str) -> int:
        found = self[chunk] = self.number(chunk)
        return found


def _numbers(known: dict[str, int], chunks: list[str]) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, chunks), np.int64, len(chunks))


def _latest(known: defaultdict, seen: int) -> list[tuple[str, int]]:
    return list(itertools.islice(reversed(known.items()), len(known) - seen))[::-1]


@lru_cache(maxsize=1)
def _encoder(path: str) -> _Encoder:
    """One for all tasks of a worker, since the next task has many of the same words."""
    return _Encoder(path)


def _of_bytes(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """First row and number of rows of stretches of about ``most`` bytes, a row at least."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = ends[start] - sizes[start]
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop - start
        start = stop


def token_rows(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """``doc_id``, ``n``, ``crc`` and packed ``ids`` (see ``id_type``) of every text, end id last.

    Every task adds a row of its own at the end, with ``counts`` of its ids (64-bit, one
    per id from 0) in place of ids, so that they need not be read again to be counted.
    """
    kind = docs.schema["doc_id"].dataType
    schema = pa.schema(
        [
            ("doc_id", to_arrow_type(kind)),
            ("n", pa.int64()),
            ("crc", pa.int64()),
            ("ids", pa.binary()),
            ("counts", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        total = np.zeros(encoder.tokenizer.get_vocab_size(), dtype=np.int64)
        for batch in batches:
            for start, rows in _of_bytes(batch.column("text"), ENCODED_BYTES):
                part = batch.slice(start, rows)
                ids, ends = encoder.encode_column(part.column("text"))
                whole = np.insert(ids, ends, end_id)
                total += np.bincount(whole, minlength=len(total))
                last = np.r_[0, ends + np.arange(1, rows + 1)]
                cuts = last * encoder.kind.itemsize
                raw = whole.tobytes()
                own = [raw[lo:hi] for lo, hi in itertools.pairwise(cuts.tolist())]
                columns = [
                    part.column("doc_id"),
                    pa.array(np.diff(last), pa.int64()),
                    pa.array([zlib.crc32(i) for i in own], pa.int64()),
                    pa.array(own, pa.binary()),
                    pa.nulls(rows, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if total.any():
            yield pa.RecordBatch.from_pylist([{"counts": total.tobytes()}], schema)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind.simpleString()}, n bigint, crc bigint, ids binary, counts binary"
    )


def id_counts(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs, from the rows of counts: one number per id is returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("counts"):
                n = np.frombuffer(value.as_py(), dtype=np.int64)
                (used,) = n.nonzero()
                yield pa.RecordBatch.from_pydict({"id": used.astype(np.int64), "n": n[used]})

    own = tokens.filter(F.col("counts").isNotNull()).select("counts")
    sums = own.mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return {r["id"]: r["n"] for r in sums.toLocalIterator()}


def code_lengths(counts: dict[int, int], limit: int = LIMIT) -> dict[int, int]:
    """Best code lengths of at most ``limit`` bits: Huffman, or package-merge if it is deeper."""
    if len(counts) <= 1:
        return dict.fromkeys(counts, 1)
    if len(counts) > 1 << limit:
        raise ValueError(f"{len(counts)} ids do not fit in codes of {limit} bits")
    heap = [(n, i, (i,)) for i, n in sorted(counts.items())]
    parent: dict[int, int] = {}
    nodes = [(n, k) for k, (n, _, _) in enumerate(heap)]
    symbols = [i for _, i, _ in heap]
    heapq.heapify(nodes)
    fresh = len(symbols)
    while len(nodes) > 1:
        (n, a), (m, b) = heapq.heappop(nodes), heapq.heappop(nodes)
        parent[a] = parent[b] = fresh
        heapq.heappush(nodes, (n + m, fresh))
        fresh += 1
    depth = [0] * fresh
    for k in range(fresh - 2, -1, -1):
        depth[k] = depth[parent[k]] + 1
    if max(depth[: len(symbols)]) <= limit:
        return {s: depth[k] for k, s in enumerate(symbols)}
    return _package_merge(counts, limit)


def _package_merge(counts: dict[int, int], limit: int) -> dict[int, int]:
    symbols = np.asarray(sorted(counts, key=lambda i: (counts[i], i)))
    weights = np.asarray([counts[i] for i in symbols], dtype=np.float64)
    leaves = len(symbols)
    levels, items = [], weights
    for _ in range(limit - 1):
        # two lists merged in order; packages are pairs of the level below
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        joined = np.concatenate([weights, packages])
        order = np.argsort(joined, kind="stable")
        levels.append(order < leaves)
        items = joined[order]
    lengths = np.zeros(leaves, dtype=np.int64)
    take = 2 * leaves - 2
    for is_leaf in reversed(levels):
        chosen = is_leaf[:take]
        n_leaves = int(chosen.sum())
        lengths[:n_leaves] += 1
        take = 2 * (take - n_leaves)
    lengths[:take] += 1
    return dict(zip(symbols.tolist(), lengths.tolist(), strict=True))


class CodeBook:
    """Canonical codes from lengths: shorter first, then by id."""

    def __init__(self, lengths: dict[int, int]):
        ids = np.fromiter(lengths, np.int64, len(lengths))
        widths = np.fromiter(lengths.values(), np.int64, len(lengths))
        order = np.lexsort((ids, widths))
        ids, widths = ids[order], widths[order]
        size = int(ids.max(initial=-1)) + 1
        self.lengths = np.zeros(size, dtype=np.int64)
        self.codes = np.zeros(size, dtype=np.int64)
        self.bits = max(lengths.values(), default=1)
        # all prefixes that begin with a code stand together, in the order of the codes
        prefixes = 1 << (self.bits - widths)
        self.lengths[ids] = widths
        self.codes[ids] = (np.cumsum(prefixes) - prefixes) >> (self.bits - widths)
        # id and width of the code at each prefix, in one number: one look-up per id
        self.table = np.zeros(1 << self.bits, dtype=np.uint32)
        self.table[: int(prefixes.sum())] = np.repeat(ids << 5 | widths, prefixes)

    def pack(
        self, ids: np.ndarray, counts: np.ndarray, stride: int = STRIDE
    ) -> tuple[list[bytes], list[np.ndarray]]:
        """Per document its payload, and the bit offset of every ``stride``-th id in it."""
        if not len(ids):
            return [b""] * len(counts), [np.zeros(0, dtype=np.int64)] * len(counts)
        widths = self.lengths[ids]
        ends = np.cumsum(widths)
        last = np.cumsum(counts)
        bits = np.diff(np.r_[0, np.r_[0, ends][last]])
        size = (bits + 7) // 8  # a document begins at a byte
        begin = np.cumsum(size) - size
        inside = ends - widths - np.repeat(np.r_[0, ends][last] - bits, counts)
        starts = inside + np.repeat(begin * 8, counts)
        cells = np.zeros(int(size.sum()) // 4 + 3, dtype=np.uint64)
        # a code lies in one or two 32-bit cells, as part of a 64-bit window
        shifted = self.codes[ids].astype(np.uint64) << (64 - (starts & 31) - widths).astype(
            np.uint64
        )
        cell = starts >> 5
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        window = np.bitwise_or.reduceat(shifted, first)
        cells[cell[first]] |= window >> np.uint64(32)
        cells[cell[first] + 1] |= window & np.uint64(0xFFFFFFFF)
        raw = cells.astype(">u4").tobytes()
        payloads = [raw[b : b + n] for b, n in zip(begin.tolist(), size.tolist(), strict=True)]
        offsets = [
            inside[e - n : e : stride] for e, n in zip(last.tolist(), counts.tolist(), strict=True)
        ]
        return payloads, offsets

    def unpack(
        self,
        payload: bytes,
        checkpoints: np.ndarray,
        counts: np.ndarray,
        stride: int = STRIDE,
    ) -> np.ndarray:
        """The ids of all documents; every stretch advances one id per step."""
        raw = np.frombuffer(payload + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
        window = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
        stretches = -(-counts // stride)
        size = np.full(len(checkpoints), stride, dtype=np.int64)
        last = np.cumsum(stretches)[stretches > 0] - 1
        size[last] = (counts - (stretches - 1) * stride)[stretches > 0]
        begin = np.cumsum(size) - size
        longest = np.argsort(-size, kind="stable")
        at, place = checkpoints[longest].astype(np.uint32), begin[longest]
        out = np.zeros(int(size.sum()), dtype=np.uint32)
        alive = np.searchsorted(-size[longest], -np.arange(stride), side="left")
        top = np.uint32(32 - self.bits)
        mask = np.uint32((1 << self.bits) - 1)
        for step in range(int(size.max(initial=0))):
            live = at[: alive[step]]
            # a prefix of at most 25 bits begins anywhere in a byte of the window
            seen = self.table[(window[live >> 3] >> (top - (live & 7))) & mask]
            out[place[: alive[step]] + step] = seen >> 5
            live += seen & 31
        return out


def _order(doc_id, crc: int) -> tuple:
    return (False, crc) if doc_id is None else (True, doc_id, crc)


def part_bounds(tokens: DataFrame, parts: int) -> list[tuple]:
    """Where every part but the first begins, for parts of about equal rows.

    Spark's ranges of ``doc_id`` and checksum are the parts, so an id that many rows share is
    spread over several. One row per part is returned.
    """
    if parts < 2:
        return []
    ranges = tokens.select("doc_id", "crc").repartitionByRange(parts, "doc_id", "crc")
    least = (
        ranges.groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min(F.struct("doc_id", "crc")).alias("low"))
        .select("low.*")
    )
    return sorted(_order(*r) for r in least.toLocalIterator())[1:]


def coded_rows(
    tokens: DataFrame, packed: np.dtype, lengths: dict[int, int], bounds: list[tuple]
) -> DataFrame:
    """``part``, ``doc_id``, ``crc``, ``n``, ``payload`` and ``offsets`` of every document."""
    kind = tokens.schema["doc_id"].dataType.simpleString()
    shared = tokens.sparkSession.sparkContext.broadcast(lengths)  # an entry per id in use

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = CodeBook(shared.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                raw = part.column("ids").to_pylist()
                ids = np.frombuffer(b"".join(raw), dtype=packed).astype(np.int64)
                counts = np.asarray([len(r) // packed.itemsize for r in raw], dtype=np.int64)
                payloads, offsets = book.pack(ids, counts)
                own = zip(
                    part.column("doc_id").to_pylist(), part.column("crc").to_pylist(), strict=True
                )
                place = [bisect.bisect_right(bounds, _order(*o)) for o in own]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array(place, pa.int32()),
                        "doc_id": part.column("doc_id"),
                        "crc": part.column("crc"),
                        "n": pa.array(counts),
                        "payload": pa.array(payloads, pa.binary()),
                        "offsets": pa.array(offsets, pa.list_(pa.int64())),
                    }
                )

    return tokens.select("doc_id", "crc", "ids").mapInArrow(
        run, f"part int, doc_id {kind}, crc bigint, n bigint, payload binary, offsets array<bigint>"
    )


def write_blocks(coded: DataFrame, parts: int, lengths: dict[int, int], path: str) -> None:
    """Write documents in global ``doc_id`` order as blocks of about ``BLOCK_IDS`` ids.

    The code words are made before the rows are put in order, so that the shuffle moves
    them and not the ids; a block only joins the payloads of its documents. Every part goes
    to the task of its own number.
    """
    spark = coded.sparkSession
    kind = coded.schema["doc_id"].dataType
    schema = (
        f"part int, block bigint, first bigint, doc_ids array<{kind.simpleString()}>,"
        " counts array<bigint>, payload binary, stride int, checkpoints array<bigint>"
    )
    lists = pa.list_(pa.int64())
    arrow = pa.schema(
        [
            ("part", pa.int32()),
            ("block", pa.int64()),
            ("first", pa.int64()),
            ("doc_ids", pa.list_(to_arrow_type(kind))),
            ("counts", lists),
            ("payload", pa.binary()),
            ("stride", pa.int32()),
            ("checkpoints", lists),
        ]
    )

    def block(part: int, number: int, first: int, rows: list[tuple]) -> pa.RecordBatch:
        begin = np.cumsum([0, *[len(r[2]) for r in rows]]) * 8
        checkpoints = np.concatenate(
            [np.asarray(r[3], dtype=np.int64) + b for r, b in zip(rows, begin, strict=False)]
        )
        one = {
            "part": part,
            "block": number,
            "first": first,
            "doc_ids": [r[0] for r in rows],
            "counts": [r[1] for r in rows],
            "payload": b"".join(r[2] for r in rows),
            "stride": STRIDE,
            "checkpoints": checkpoints.tolist(),
        }
        return pa.RecordBatch.from_pylist([one], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, held, number, first = None, [], 0, 0, 0
        for batch in batches:
            names = ("part", "doc_id", "n", "payload", "offsets")
            for part, *row in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
                if rows and (part != now or held >= BLOCK_IDS):
                    yield block(now, number, first, rows)
                    rows, held, number, first = [], 0, number + 1, first + held
                if part != now:
                    now, number, first = part, 0, 0
                rows.append(row)
                held += row[1]
        if rows:
            yield block(now, number, first, rows)

    dealt = coded.repartitionById(parts, "part")
    ordered = dealt.sortWithinPartitions("part", "doc_id", "crc", "payload")
    blocks = f"{path}/blocks"
    ordered.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(blocks)
    # one entry per id of the vocabulary in use
    book = spark.createDataFrame(sorted(lengths.items()), "id bigint, bits int")
    book.coalesce(1).write.parquet(f"{path}/book")
    # one row per part: ids before a part are the ids of the parts in front of it
    sizes = (
        spark.read.parquet(blocks)
        .groupBy("part")
        .agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("size"))
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before")).write.parquet(
        f"{path}/parts"
    )


def _together(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """First row and number of rows of blocks that are decoded side by side: of one stride, and
    about ``DECODED_BYTES`` of payload."""
    start = held = 0
    strides = batch.column("stride").to_pylist()
    for row, size in enumerate(pc.binary_length(batch.column("payload")).to_pylist()):
        if row > start and (held + size > DECODED_BYTES or strides[row] != strides[start]):
            yield start, row - start
            start = row
            held = 0
        held += size
    if batch.num_rows:
        yield start, batch.num_rows - start


def read_blocks(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document, from the files: ``start``, ``n_tokens``, ``ids_crc32``; packed ``ids`` on request."""
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    lengths = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/book").toLocalIterator()}
    shared = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = CodeBook(shared.value)
        for batch in batches:
            for start, rows in _together(batch):
                part = batch.slice(start, rows)
                n_docs, n_checks = (
                    pc.list_value_length(part.column(c)).to_numpy() for c in ("counts", "checkpoints")
                )
                payloads = part.column("payload").to_pylist()
                begin = np.cumsum([0, *map(len, payloads)])[:-1] * 8
                counts = part.column("counts").flatten().to_numpy()
                ids = book.unpack(
                    b"".join(payloads),
                    part.column("checkpoints").flatten().to_numpy() + np.repeat(begin, n_checks),
                    counts,
                    part.column("stride")[0].as_py(),
                )
                ends = np.cumsum(counts)
                whole = memoryview(ids.astype("<u4", copy=False).tobytes())
                raw = [
                    whole[4 * (end - n) : 4 * end]
                    for end, n in zip(ends.tolist(), counts.tolist(), strict=True)
                ]
                # ids in front of a document within its own block
                before = ends - counts
                before -= np.repeat(before[np.cumsum(n_docs) - n_docs], n_docs)
                first = np.repeat(part.column("first").to_numpy(), n_docs)
                columns = {
                    "part": pa.array(np.repeat(part.column("part").to_numpy(), n_docs)),
                    "place": pa.array(first + before),
                    "doc_id": part.column("doc_ids").flatten(),
                    "n_tokens": pa.array(counts, pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([bytes(r) for r in raw], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    schema = f"part int, place bigint, doc_id {kind}, n_tokens bigint, ids_crc32 bigint"
    schema += ", ids binary" if with_ids else ""
    decoded = blocks.mapInArrow(run, schema)
    starts = spark.read.parquet(f"{path}/parts").withColumnRenamed("part", "_part")
    joined = decoded.join(starts, F.col("part") == F.col("_part"))
    return joined.select(
        "doc_id",
        (F.col("before") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
        *(["ids"] if with_ids else []),
    )


def stored_tokens(
    docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Encode, count, write the files to the shared folder, and read them back.

    Ids are written once before the code is made, so texts are encoded once; the files
    need one ordering shuffle of the code words, into parts of about ``PART_IDS`` ids
    by bounds of ``doc_id``. What goes to the driver is one row per id of the vocabulary and
    one bound per part; what is broadcast is the code book and these bounds. The reader knows
    the files alone.
    """
    spark = ship(docs.sparkSession)
    staged = scratch_path(spark, "tokens")
    token_rows(docs, tokenizer_path, end_id).write.option("compression", "zstd").parquet(staged)
    stored = spark.read.parquet(staged)
    counts = id_counts(stored)
    lengths = code_lengths(counts, max(LIMIT, len(counts).bit_length()))
    tokens = stored.filter(F.col("counts").isNull())
    parts = max(1, -(-sum(counts.values()) // PART_IDS))
    files = scratch_path(spark, "token-blocks")
    bounds = part_bounds(tokens, parts)
    coded = coded_rows(tokens, id_type(tokenizer_path), lengths, bounds)
    write_blocks(coded, parts, lengths, files)
    return read_blocks(spark, files, with_ids)
