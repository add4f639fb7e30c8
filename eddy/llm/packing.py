"""Best-fit packing of tokenised documents by bin completion (operator 10).

A document becomes the ids of a public tokenizer followed by an end id. Only
documents longer than the capacity are cut, into full pieces and a rest. The
pieces are packed into as few sequences of ``capacity`` tokens as can be found:

* Best-fit decreasing gives the incumbent.
* If it needs more sequences than ``ceil(tokens / capacity)``, a depth-first
  branch-and-bound completes one sequence after the other: the largest piece
  that is left opens it, and all undominated fillings of the rest of the sequence
  are tried in order of waste, each made when its turn comes (sums that pieces can
  have are bits of an integer). A branch ends as soon as its waste exceeds what a
  packing with one sequence less may waste. The least number of sequences takes
  exponential time in the worst case, so a group may try ``nodes`` fillings for each
  of its pieces; the incumbent stays if nothing better was found by then.

Scale: tokenising is the work; every task encodes each distinct word once and
joins ids by number; the word table lives in the Python worker and holds about
``CACHE_WORDS`` words, those met lately. Pieces are rows of a
few numbers. They are dealt by hash into groups of about ``group_rows`` pieces
and each group is packed by itself, which costs at most one half-full sequence
per group (under 0.1 % of the sequences at the default). No piece is dropped
and no text is shortened; groups do not depend on length or source, so equal
documents do not pile up. The driver reads one count.

Edge cases: a NULL or empty text is the end id alone. NULL ids and repeated
rows are ordinary rows; ties are broken by (id, piece, place). An empty table
gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import json
import operator
import re
import sys
import unicodedata
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, parts_for, ship_by_value, small_batches, stored, text_column

CAPACITY = 4096
END_ID = 1
#: pieces that are packed together
GROUP_ROWS = 32768
#: fillings that the search of a group may try for each piece of it, and at least
NODES, LEAST_NODES = 4, 20_000
#: open bins of a search that keep their fillings' state; those below are begun again
KEPT_FRAMES = 32
#: distinct words whose ids a task keeps, in two tables
CACHE_WORDS = 500_000
#: bytes that part words for the word cache; the tokenizer's own pattern never
#: joins across white space, so words can be encoded one by one
PART = (" ", "\t", "\n", "\r")


#: a word of letters with punctuation behind it: two pre-tokens of the tokenizer
PLAIN = re.compile(r"([^\W\d_]+)([^\w\s]*)")
#: letters below this one are letters to every version of Unicode, and composed
LATIN_END = "\u0250"
#: such letters with ASCII punctuation behind them, as an Arrow expression; the
#: dotted capital I is left out (it becomes two characters)
LATIN = "^(?P<letters>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+)(?P<marks>[!-/:-@\\[-^`{-~]*)$"
#: words whose ids are laid side by side at once
RUN_WORDS = 1 << 14
#: letter words that are encoded in one call
RUN = 512


def kept_in_worker(name: str, make):
    """An object that lives as long as the Python worker: later tasks of the
    same worker go on with it (it only saves time)."""
    import types
    home = sys.modules.setdefault("_eddy_worker_cache", types.ModuleType("_eddy_worker_cache"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)


def strings(values: pa.Array) -> list:
    """``to_pylist`` for strings, without an Arrow scalar for each."""
    return values.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, from the ids
    of their words. A word of letters followed by punctuation is looked up by
    its lower-cased letters and its punctuation, which the tokenizer parts
    anyway; any other word is encoded as it is. A full table of words is kept as
    the old one until the next is full, and words met again move over."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.bare = self.for_letters(path)
        self.ids: dict[str, bytes] = {}
        self.old_ids: dict[str, bytes] = {}
        self.letters: dict[str, bytes] = {"": b""}
        self.old_letters: dict[str, bytes] = {}
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def for_letters(self, path: str):
        """The tokenizer without the steps that leave lower-case composed letters
        as they are, or the whole one if it has other steps."""
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
        if ([x["type"] for x in before.get("normalizers", [])] != ["NFC", "Replace", "Lowercase"]
                or [x["type"] for x in split.get("pretokenizers", [])] != ["Split", "ByteLevel"]):
            return self.tok
        spec["normalizer"] = None
        split["pretokenizers"][0] = {"type": "WhitespaceSplit"}
        bare = Tokenizer.from_str(json.dumps(spec))
        bare.encode_special_tokens = True
        return bare

    def each(self, words: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def learn_letters(self, words: list[str]) -> None:
        for at in range(0, len(words), RUN):
            part = words[at:at + RUN]
            line = " ".join(part)
            tok = self.bare if max(line) < LATIN_END else self.tok
            ids = np.asarray(tok.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) == len(part):
                data, pos = ids.tobytes(), [0, *(4 * stop).tolist()]
                self.letters.update(zip(part, (data[x:y] for x, y in zip(pos, pos[1:]))))
            else:
                self.letters.update(zip(part, self.each(part)))

    @staticmethod
    def plain(word: str):
        """``(letters, punctuation)``, or None. Sigma is left out (its lower
        case depends on the place), and so is what composition would change."""
        m = PLAIN.fullmatch(word)
        if m is None or not m[1].isalpha() or not (word.isascii() or (unicodedata.is_normalized("NFC", word) and "\u03a3" not in word)):
            return None
        return m[1].lower(), m[2]

    def learn(self, words: list[str]) -> None:
        """Ids of new words. Latin words are parted by Arrow, others one by one."""
        parts = pc.extract_regex(pa.array(words, pa.string()), LATIN)
        letters = strings(pc.utf8_lower(pc.struct_field(parts, [0])))
        marks = strings(pc.struct_field(parts, [1]))
        whole = np.flatnonzero(~parts.is_valid().to_numpy(zero_copy_only=False)).tolist()
        odd = []
        for i in whole:
            own = None if words[i].isascii() else self.plain(words[i])
            letters[i], marks[i] = own or ("", "")
            if own is None:
                odd.append(words[i])
        need = {x for x in {*letters, *marks} if x not in self.letters}
        again = need & self.old_letters.keys()
        self.letters.update((x, self.old_letters[x]) for x in again)
        need -= again
        self.learn_letters([x for x in need if x.isalpha()])
        rest = [x for x in need if not x.isalpha()]
        self.letters.update(zip(rest, self.each(rest)))
        get = self.letters.__getitem__
        self.ids.update(zip(words, map(operator.add, map(get, letters), map(get, marks))))
        self.ids.update(zip(odd, self.each(odd)))

    def of_words(self, words: list[str]) -> list[bytes]:
        if len(self.ids) > CACHE_WORDS // 2:
            self.ids, self.old_ids = {}, self.ids
        if len(self.letters) > CACHE_WORDS // 2:
            self.letters, self.old_letters = {"": b""}, self.letters
        out = list(map(self.ids.get, words))
        new = [w for w, x in zip(words, out) if x is None]
        if new:
            old = self.old_ids
            self.ids.update((w, old[w]) for w in new if w in old)
            self.learn([w for w in new if w not in old])
            out = list(map(self.ids.__getitem__, words))
        return out

    def encode(self, texts) -> list[bytes]:
        """``texts``: a list, or an Arrow array of strings."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        for p in PART[1:]:
            texts = pc.replace_substring(texts, p, PART[0])
        words = pc.split_pattern(texts, PART[0])
        coded = words.flatten().dictionary_encode()
        parts = self.of_words(strings(coded.dictionary))
        size = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        ids = np.frombuffer(b"".join(parts), "<u4")
        at, word = np.cumsum(size) - size, coded.indices.to_numpy()
        out = []
        for i in range(0, len(word), RUN_WORDS):  # the ids of every word in its turn
            w = word[i:i + RUN_WORDS]
            n = size[w]
            stop = np.cumsum(n)
            out.append(ids[np.repeat(at[w] - stop + n, n) + np.arange(stop[-1])].tobytes())
        data = b"".join(out)
        stop = np.concatenate([[0], np.cumsum(size[word])])
        last = 4 * stop[np.concatenate([[0], np.cumsum(pc.list_value_length(words).to_numpy())])]
        return [data[x:y] for x, y in zip(last[:-1].tolist(), last[1:].tolist())]


def slices(texts: pa.Array, budget: int = 4 << 20):
    """Consecutive runs of texts of about ``budget`` bytes."""
    start, held = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        held += n
        if held >= budget:
            yield start, texts.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < len(texts):
        yield start, texts.slice(start)


def cut_pieces(path, capacity, end_id):
    end = np.asarray([end_id], "<u4").tobytes()
    width = 4 * capacity

    def pieces(enc, b):
        ids, texts = b.column(0), b.column(1)
        row, piece, start, length, crc = [], [], [], [], []
        for at, part in slices(texts):
            for i, data in enumerate(enc.encode(part), at):
                data += end
                for k, pos in enumerate(range(0, len(data), width)):
                    own = data[pos:pos + width]
                    row.append(i)
                    piece.append(k)
                    start.append(pos // 4)
                    length.append(len(own) // 4)
                    crc.append(zlib.crc32(own))
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
             pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32"])

    def run(batches):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        enc = kept_in_worker("words_" + path, lambda: WordEncoder(path))
        for b in batches:
            yield pieces(enc, b)
            del b
            give_back()
    return run


# ------------------------------------------------------------ packing a group
def best_fit(counts: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing over a length histogram: bins as lists of lengths."""
    room: list[list[list[int]]] = [[] for _ in range(capacity + 1)]  # bins by room left
    open_rooms = 0  # bit r: some bin has room r
    bins: list[list[int]] = []
    for size in range(capacity, 0, -1):
        for _ in range(int(counts[size])):
            fit = open_rooms >> size
            if fit:
                r = size + (fit & -fit).bit_length() - 1
                own = room[r].pop()
                if not room[r]:
                    open_rooms &= ~(1 << r)
            else:
                r, own = capacity, []
                bins.append(own)
            own.append(size)
            if r - size:
                room[r - size].append(own)
                open_rooms |= 1 << (r - size)
    return bins


def span_bits(bits: int, most: int) -> int:
    """``bits`` or-ed with its shifts by 1 .. ``most``."""
    done = 0
    while done < most:
        step = min(done + 1, most - done)
        bits |= bits << step
        done += step
    return bits


def dominated(fill: tuple[int, ...], waste: int, spare: int) -> bool:
    """Whether some pieces of ``fill`` could be replaced by one other piece (bits of
    ``spare``: lengths left over) that is larger, or as large as two or more of them,
    and still fit: then they fit where that piece goes, so the filling is no better."""
    one = several = 0  # bit s: one piece, or two and more, have the sum s
    for x in fill:
        several |= (several | one) << x
        one |= 1 << x
    if several & spare:
        return True
    return bool(waste and span_bits((one | several) << 1, waste - 1) & spare)


def completions(counts: np.ndarray, gap: int):
    """All undominated fillings of ``gap`` in order of waste, made as they are asked
    for. A single piece that fills the gap dominates all others."""
    sizes = [int(x) for x in np.flatnonzero(counts[:gap + 1])]
    if not sizes:
        yield ()
        return
    if sizes[-1] == gap:
        yield (gap,)
        return
    held = [int(counts[x]) for x in sizes]
    whole = (1 << (gap + 1)) - 1
    reach = [1]  # reach[i]: bit s, some of the first i lengths have the sum s
    for x, c in zip(sizes, held):
        now, left, k = reach[-1], min(c, gap // x), 1
        while left:  # c copies as blocks of 1, 2, 4, ... copies
            k = min(k, left)
            now |= (now << (x * k)) & whole
            left -= k
            k *= 2
        reach.append(now)

    def exact(total, upto):
        """Multisets of the first ``upto`` lengths with this sum, larger pieces first."""
        if not total:
            yield ()
            return
        for i in range(upto - 1, -1, -1):
            if not reach[i + 1] >> total & 1:
                return
            x = sizes[i]
            for c in range(min(held[i], total // x), 0, -1):
                if reach[i] >> (total - c * x) & 1:
                    for rest in exact(total - c * x, i):
                        yield (x,) * c + rest

    for total in range(gap, 0, -1):
        if not reach[-1] >> total & 1:
            continue
        waste = gap - total
        for fill in exact(total, len(sizes)):
            used = {x: fill.count(x) for x in set(fill)}
            spare = sum(1 << x for x, c in zip(sizes, held) if c > used.get(x, 0))
            # a piece that still fits beside them dominates as well
            if not spare & ((1 << (waste + 1)) - 1) and not dominated(fill, waste, spare):
                yield fill


def complete_bins(counts: np.ndarray, capacity: int, nodes: int) -> list[list[int]]:
    """Bins as lists of lengths: branch and bound by bin completion, with
    best-fit decreasing as the first incumbent."""
    incumbent = best_fit(counts, capacity)
    total = int((np.arange(capacity + 1) * counts).sum())
    bound = -(-total // capacity)
    if len(incumbent) <= bound:
        return incumbent
    left = counts.astype(np.int64).copy()
    # a frame per open bin: [lengths in it, waste before it, its fillings, largest piece, fillings taken]
    stack: list[list] = []

    def opened(waste):
        big = int(np.flatnonzero(left)[-1])
        left[big] -= 1
        stack.append([None, waste, completions(left.copy(), capacity - big), big, 0])
        if len(stack) > KEPT_FRAMES:
            stack[-KEPT_FRAMES - 1][2] = None

    opened(0)
    while stack and nodes > 0:
        frame = stack[-1]
        own, waste, _, big, taken = frame
        if own is not None:  # take back the last try
            for x in own[1:]:
                left[x] += 1
            frame[0] = None
        if frame[2] is None:  # the pieces left are those it was opened with
            frame[2] = islice(completions(left.copy(), capacity - big), taken, None)
        fill = next(frame[2], None)
        frame[4] += 1
        # later fillings waste more, so the first that wastes too much ends the frame
        if fill is None or waste + capacity - big - sum(fill) > (len(incumbent) - 1) * capacity - total:
            left[big] += 1
            stack.pop()
            continue
        nodes -= 1
        for x in fill:
            left[x] -= 1
        frame[0] = (big, *fill)
        if left.any():
            opened(waste + capacity - big - sum(fill))
        else:
            incumbent = [list(f[0]) for f in stack]
            if len(incumbent) <= bound:
                break
    return incumbent


def pack_group(capacity, nodes):
    def run(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        length = pdf["length"].to_numpy()
        bins = complete_bins(np.bincount(length, minlength=capacity + 1), capacity, max(LEAST_NODES, nodes * len(length)))
        # rows of one length are interchangeable: hand them out in sorted order
        first = np.searchsorted(-length, -np.arange(capacity + 1), side="left")
        used = np.zeros(capacity + 1, np.int64)
        seq = np.empty(len(pdf), np.int64)
        off = np.empty(len(pdf), np.int64)
        for s, sizes in enumerate(bins):
            at = 0
            for x in sizes:
                i = first[x] + used[x]
                used[x] += 1
                seq[i], off[i] = s, at
                at += x
        group = int(pdf["grp"].iloc[0]) if len(pdf) else 0
        return pdf.assign(sequence_id=(group << 32) + seq, offset=off)[
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]
    return run


def contract_tokenizer() -> str:
    """Path of the public tokenizer of the packing contract."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), text_column(text_col).alias("text"))
    return rows.mapInArrow(cut_pieces(path, capacity, end_id),
                           f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit_pack(docs: DataFrame, path: str, *, capacity: int = CAPACITY, end_id: int = END_ID,
                  group_rows: int = GROUP_ROWS, nodes: int = NODES,
                  id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``: every
    piece with its place in a sequence of at most ``capacity`` tokens. ``path``
    is the tokenizer file, readable by every task."""
    small_batches(docs.sparkSession)
    pieces = stored(token_pieces(docs, path, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col), "pieces")
    groups = parts_for(docs.sparkSession, pieces.count(), group_rows)
    # equal rows must not meet in one group: the place in the stored table is part of the hash
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)).cast("int"))
    kind = docs.schema[id_col].dataType.simpleString()
    return dealt.groupBy("grp").applyInPandas(
        pack_group(capacity, nodes),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


ship_by_value(__name__)
