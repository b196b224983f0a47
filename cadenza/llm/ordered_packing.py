"""Packing in order: dynamic programming over window cuts.

Documents, in the order of their ids, form one stream of tokens, which is cut into sequences of at most WINDOW tokens. Allowed cuts are
document ends, sentence ends (after a token of sentence signs that no digit follows) and, in stretches of more than STRETCH tokens without
either and in the last window of a block, single tokens. A sequence costs its padding (WINDOW less its length, nothing at a power of
two), SEQUENCE, and the penalty of the cut that ends it: 0 at a document's end, SENTENCE or TOKEN inside one. With f(j) the least cost up
to cut j,

    f(j) = penalty(j) + SEQUENCE + min(WINDOW - c(j) + min over cuts i within the window of (f(i) + c(i)), min over powers p of f(at c(j) - p)).

The inner minimum slides with the window: a monotone queue gives it in constant time a cut. The result is the cheapest set of cuts of
a block, a run of whole documents of about BLOCK tokens.

Texts are tokenised once, in Arrow batches, by words, with a bounded memory of known ones; ids are stored as Parquet in the shared
folder (2 bytes an id). A range partitioning by id
and a hash of the ids gives runs of the stream of about PARTITION tokens; each is sorted and then read in order, a block at a time, so
that a task holds one block and one document. A block's last sequence may be short: that is the price of cutting the stream, at most one window a block.

Defined cases: null and empty texts have the end token alone; a null id comes first; documents with equal ids follow each other by their
tokens, repeated rows in any order; an empty table gives an empty result; columns besides id and text are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import cut_table

WINDOW = 2048
END = 1
#: Costs, in tokens of padding: of each sequence, of a cut at a sentence's end, of a cut elsewhere in a document.
SEQUENCE, SENTENCE, TOKEN = 4, 16, 48
#: Longer stretches without an end of a sentence may be cut every STRIDE tokens.
STRETCH, STRIDE = 256, 64
BLOCK = 1 << 20
PARTITION = 4 << 20
#: A task keeps the ids of at most so many different words, tokenises so many at a time, and takes about so many characters of a text at a time.
WORDS, GROUP, CHARS = 1 << 20, 4096, 1 << 22
BAR = "|"
SIGNS = ".,;:!?"
#: Arrow takes these for white space; regular expressions of tokenizers don't.
ODD = "[\x1c-\x1f]"
#: Letters whose lower case is not one letter by itself.
SPECIAL = "[\u0130\u03a3]"


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task a core
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _light(path: str):
    """The tokenizer's model on words of lower-case letters between blanks."""
    from tokenizers import Tokenizer, pre_tokenizers
    t = Tokenizer(_tokenizer(path).model)
    t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return t


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Words(dict):
    """Ids of white-space-delimited words as bytes, for a tokenizer whose tokens never cross white space (checked by ``splits_at_blanks``): a text's
    ids are those of its words. Arrow splits a group of texts and finds its different words; only these are looked up here. Words of
    letters, with a point or the like at their end or without, are kept in lower case without that sign, which is a token of its own; unknown
    ones are tokenised as one text, whose ids are cut where a token ends a word."""

    def __init__(self, path: str, limit: int = WORDS):
        super().__init__()
        self.tokenizer, self.limit = _tokenizer(path), limit
        vocab, suffix = self.tokenizer.get_vocab(), json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.kind = np.dtype("<u2" if len(vocab) <= 1 << 16 else "<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for k, i in vocab.items() if suffix and k.endswith(suffix)]] = True
        self.signs = {x: self.plain([x])[0] for x in [*SIGNS, BAR]}
        self.sign_names, self.sign_ids = pa.array(list(SIGNS), pa.large_string()), pa.array([self.signs[x] for x in SIGNS], pa.large_binary())
        self.light = _light(path)

    def others(self, words: list[str]) -> None:
        """Learns words of any signs; those without a bar as one text with bars between them."""
        bar = self.signs[BAR]
        some = [w for w in words if w and BAR not in w] if len(bar) == self.kind.itemsize else []
        if some:
            ids = np.array(self.tokenizer.encode_batch_fast([f" {BAR} ".join(some)], add_special_tokens=False)[0].ids, dtype=self.kind)
            cut = np.flatnonzero(ids == np.frombuffer(bar, self.kind)[0]) * self.kind.itemsize
            raw, ends, starts = ids.tobytes(), [*cut.tolist(), ids.nbytes], [0, *(cut + self.kind.itemsize).tolist()]
            self.update(zip(some, [raw[x:y] for x, y in zip(starts, ends, strict=True)], strict=True))
        rest = [w for w in words if w not in self]
        self.update(zip(rest, self.plain(rest), strict=True))

    def plain(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def letters(self, words: list[str]) -> None:
        """Learns words of lower-case letters, which need neither lower-casing nor a search for signs and digits."""
        text = " ".join(words)
        if is_normalized("NFC", text):
            ids = np.array(self.light.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)
            cut = (np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize
            if len(cut) == len(words) and cut[-1] == ids.nbytes:
                raw, at = ids.tobytes(), [0, *cut.tolist()]
                self.update(zip(words, [raw[x:y] for x, y in zip(at, at[1:])], strict=False))
                return
        self.update(zip(words, self.plain(words), strict=True))  # a tokenizer without ends of words, or letters that it would compose

    def of(self, words: pa.Array) -> pa.Array:
        """The ids of different words."""
        sign = pc.index_in(pc.utf8_slice_codeunits(words, -1), self.sign_names)
        core = pc.if_else(sign.is_valid(), pc.utf8_slice_codeunits(words, 0, -1), words)
        low = pc.utf8_lower(core)
        made = pc.and_(pc.and_(pc.utf8_is_alpha(core), pc.utf8_is_alpha(low)), pc.invert(pc.match_substring_regex(core, SPECIAL)))
        cores = low.filter(made).dictionary_encode()
        ids = self.known(cores.dictionary.to_pylist(), self.letters).take(cores.indices)
        tails = pc.fill_null(self.sign_ids.take(sign.filter(made)), b"")
        others = self.known(words.filter(pc.invert(made)).to_pylist(), self.others)
        # the two kinds in the order of the words
        both = pa.concat_arrays([pc.binary_join_element_wise(ids, tails, pa.scalar(b"", ids.type)), others])
        made = made.to_numpy(zero_copy_only=False)
        place = np.empty(len(made), np.int64)
        place[made], place[~made] = np.arange(made.sum()), made.sum() + np.arange((~made).sum())
        return both.take(pa.array(place))

    def known(self, words: list[str], learn) -> pa.Array:
        """The ids of words; unknown ones are learnt first, GROUP at a time."""
        unknown = [w for w in words if w not in self]
        if len(self) + len(unknown) > self.limit:
            self.clear()
            unknown = words
        for a in range(0, len(unknown), GROUP):
            learn(unknown[a:a + GROUP])
        return pa.array([self[w] for w in words], pa.large_binary())


@functools.lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def splits_at_blanks(path: str) -> bool:
    """Whether the tokenizer drops white space before it looks for tokens in the bytes of words, and treats each character alone before that."""
    t = json.loads(_tokenizer(path).to_str())
    alone = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "Replace"}
    norms = (t["normalizer"] or {}).get("normalizers", [t["normalizer"]])
    splits = (t["pre_tokenizer"] or {}).get("pretokenizers", [])
    drops = any(s["type"] == "Split" and s["invert"] and s["behavior"] == "Removed" and "\\s" in s["pattern"].get("Regex", "") for s in splits[:1])
    return drops and [s["type"] for s in splits[1:]] == ["ByteLevel"] and not splits[1]["add_prefix_space"] and not splits[1]["use_regex"] and all(n and n["type"] in alone for n in norms)


def token_ids(texts: pa.Array | list, path: str, end: int = END, chars: int = CHARS) -> Iterator[np.ndarray]:
    """The ids of each text and ``end``, groups of about ``chars`` bytes (or one longer text) at a time. A text with separators that
    tokenizers don't take for white space goes to the tokenizer as it is."""
    words = _words(path)
    stop = np.array([end], dtype=words.kind).tobytes()
    texts = pc.fill_null((texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string()), "")
    group = np.cumsum(pc.binary_length(texts).to_numpy()) // chars
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for lo, hi in zip(edges, edges[1:]):
        some = texts.slice(lo, hi - lo)
        strange = pc.match_substring_regex(some, ODD)
        odd = {k: words.plain([some[k].as_py()])[0] for k in np.flatnonzero(strange.to_numpy(zero_copy_only=False)).tolist()}
        lists = pc.utf8_split_whitespace(pc.if_else(strange, "", some) if odd else some)
        coded = lists.flatten().dictionary_encode()
        ids = words.of(coded.dictionary).take(coded.indices)
        _, at, data = ids.buffers()
        ends = np.frombuffer(at, np.int64)[ids.offset:][lists.offsets.to_numpy()].tolist()
        for k, (x, y) in enumerate(zip(ends, ends[1:])):
            mine = odd[k] if k in odd else data[x:y].to_pybytes() if y > x else b""
            yield np.frombuffer(mine + stop, dtype=words.kind)


def sentence_signs(path: str) -> tuple[list[int], list[int]]:
    """Ids of tokens that end a sentence (signs only, one of them . ! ? or the like), and of digits."""
    vocab = {k.removesuffix("</w>"): [] for k in _tokenizer(path).get_vocab()}
    for k, i in _tokenizer(path).get_vocab().items():
        vocab[k.removesuffix("</w>")].append(i)
    ends = [i for k, ids in vocab.items() if re.fullmatch(r"""[.!?…]+[)"'\]]*""", k) for i in ids]
    return sorted(ends), sorted(i for k, ids in vocab.items() if k.isdigit() and k.isascii() for i in ids)


def tokenised(docs: DataFrame, id_col: str, text_col: str, path: str, end: int = END) -> DataFrame:
    """(id, ids, n): the token ids of each document as little-endian integers of 2 bytes (4 for larger vocabularies), and their number."""
    kind = docs.schema[id_col].dataType

    def run(batches):
        for b in batches:
            ids, at = [], 0
            for x in token_ids(b.column(1), path, end):
                ids.append(x)
                if sum(map(len, ids)) >= BLOCK:
                    yield emit(b, at, ids)
                    at, ids = at + len(ids), []
            if ids:
                yield emit(b, at, ids)

    def emit(b, at, ids):
        return pa.RecordBatch.from_arrays([b.column(0).slice(at, len(ids)), pa.array([x.tobytes() for x in ids], pa.binary()),
                                           pa.array([len(x) for x in ids], pa.int64())], ["id", "ids", "n"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind.simpleString()}, ids binary, n long")


def candidates(ids: np.ndarray, ends: np.ndarray, signs: np.ndarray, digits: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Allowed cuts of a block in ascending order, from 0 to its end, and their penalties. ``ends``: the documents' ends."""
    n = len(ids)
    cost = np.full(n + 1, -1, dtype=np.int64)
    sign = np.flatnonzero(np.isin(ids, signs))
    follows = np.minimum(sign + 1, n - 1)
    cost[sign[~np.isin(ids[follows], digits)] + 1] = SENTENCE
    cost[ends], cost[0] = 0, 0
    at = np.flatnonzero(cost >= 0)
    for k in np.flatnonzero(np.diff(at) > STRETCH):
        cost[at[k] + STRIDE:at[k + 1]:STRIDE] = TOKEN
    last = cost[max(0, n - window):]
    last[last < 0] = TOKEN
    at = np.flatnonzero(cost >= 0)
    return at, cost[at]


def best_cuts(at: np.ndarray, penalty: np.ndarray, window: int = WINDOW) -> tuple[int, list[int]]:
    """The least cost of cutting at some of the positions ``at`` (first and last included, gaps of at most ``window``), and these cuts."""
    n = len(at)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    p = 1
    while p < window:
        k = np.minimum(np.searchsorted(at, at - p), n - 1)
        hit = np.flatnonzero(at[k] == at - p)
        pairs.append((hit, k[hit]))
        p *= 2
    to = np.concatenate([h for h, _ in pairs])
    order = np.argsort(to, kind="stable")
    to, source = [*to[order].tolist(), n], np.concatenate([k for _, k in pairs])[order].tolist()
    c, fee = at.tolist(), (penalty + SEQUENCE).tolist()
    f, back = [0] * n, [0] * n
    queue, key, head, next_pair = [0], [c[0]], 0, 0  # cuts within the window with ascending f(i) + c(i)
    for j in range(1, n):
        low = c[j] - window
        while c[queue[head]] < low:
            head += 1
        best, i = window - c[j] + key[head], queue[head]
        while to[next_pair] == j:
            k = source[next_pair]
            if f[k] < best:
                best, i = f[k], k
            next_pair += 1
        f[j], back[j] = best + fee[j], i
        mine = f[j] + c[j]
        while len(queue) > head and key[-1] >= mine:
            queue.pop()
            key.pop()
        queue.append(j)
        key.append(mine)
    cuts, j = [], n - 1
    while j:
        cuts.append(c[j])
        j = back[j]
    return f[-1], cuts[::-1]


def cut_block(docs: list[np.ndarray], signs: np.ndarray, digits: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, list[int], np.ndarray]:
    """A run of documents' ids: all ids, the sequences' ends and the documents' ends."""
    ids, ends = np.concatenate(docs), np.cumsum([len(x) for x in docs])
    return ids, best_cuts(*candidates(ids, ends, signs, digits, window), window)[1], ends


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, capacity long"


def padded(length: np.ndarray, window: int = WINDOW) -> np.ndarray:
    return np.where((length & (length - 1)) == 0, length, window)


def _block_rows(docs: list[np.ndarray], first_sequence: int, signs, digits, window: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The pieces of a block: the place of each one's document, and the columns of PIECES."""
    ids, cuts, ends = cut_block(docs, signs, digits, window)
    edges = np.union1d(cuts, ends)
    begin = np.concatenate([[0], edges[:-1]])
    doc = np.searchsorted(ends, begin, side="right")
    starts, sizes = np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0)
    seq = np.searchsorted(cuts, begin, side="right")
    seq_at, seq_size = np.concatenate([[0], cuts[:-1]]).astype(np.int64), np.diff(cuts, prepend=0)
    wide = ids.astype("<u4")
    crc = np.array([zlib.crc32(wide[a:b]) for a, b in zip(begin, edges, strict=True)], dtype=np.int64)
    return doc, [begin - starts[doc], edges - begin, crc, sizes[doc], first_sequence + seq, begin - seq_at[seq], padded(seq_size, window)[seq]]


def blocks(batches: Iterator[pa.RecordBatch], kind, block: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Runs of whole documents of about ``block`` tokens: their ids and token ids."""
    keys, docs, size = [], [], 0
    for b in batches:
        for k in range(b.num_rows):
            docs.append(np.frombuffer(b.column(1)[k].as_py(), dtype=kind))
            keys.append(b.column(0).slice(k, 1))
            size += len(docs[-1])
            if size >= block:
                yield pa.concat_arrays(keys), docs
                keys, docs, size = [], [], 0
    if docs:
        yield pa.concat_arrays(keys), docs


def ordered(tokens: DataFrame, per_partition: int = PARTITION) -> DataFrame:
    """The stream in runs of about so many tokens, each a sorted partition."""
    total = tokens.agg(F.sum("n")).first()[0] or 0
    keyed = tokens.withColumn("h", F.xxhash64("ids"))
    return keyed.repartitionByRange(max(1, -(-total // per_partition)), F.col("id").asc_nulls_first(), "h").sortWithinPartitions(F.col("id").asc_nulls_first(), "h").drop("h")


def pack_tokens(tokens: DataFrame, signs: list[int], digits: list[int], wide: bool = False, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """The pieces (id and PIECES) of tokenised documents (id, ids, n) that are ``ordered``."""
    kind, id_type = np.uint32 if wide else np.uint16, tokens.schema["id"].dataType
    names = ["id", *[x.split()[0] for x in PIECES.split(", ")]]

    def run(batches):
        sequence = TaskContext.get().partitionId() << 33
        for keys, docs in blocks(batches, kind, block):
            doc, columns = _block_rows(docs, sequence, signs, digits, window)
            sequence = int(columns[4][-1]) + 1
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(doc)), *[pa.array(x, pa.int64()) for x in columns]], names)

    return tokens.select("id", "ids").mapInArrow(run, f"id {id_type.simpleString()}, {PIECES}")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW, end: int = END) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32 (of little-endian 4-byte ids), doc_tokens, sequence_id, offset, capacity (the length that
    the piece's sequence is padded to). ``tokenizer``: a path that all executors have."""
    path = tokenizer or default_tokenizer()
    if not splits_at_blanks(path):
        raise ValueError("the tokenizer's tokens may cross white space")
    signs, digits = sentence_signs(path)
    tokens = cut_table(tokenised(docs, id_col, text_col, path, end))
    return pack_tokens(ordered(tokens), signs, digits, _tokenizer(path).get_vocab_size() > 1 << 16, window)


def sequences(docs: DataFrame, packed: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end: int = END) -> DataFrame:
    """The packed sequences themselves, for documents with distinct ids: sequence_id, capacity, doc_ids and ids (the token ids in order)."""
    tokens = tokenised(docs, id_col, text_col, tokenizer or default_tokenizer(), end)
    j = packed.join(tokens.select("id", "ids"), "id")
    per = F.expr("octet_length(ids) div doc_tokens")  # bytes of an id
    piece = F.struct("offset", "id", F.substring(F.col("ids"), (F.col("start") * per + 1).cast("int"), (F.col("length") * per).cast("int")).alias("ids"))
    g = j.groupBy("sequence_id").agg(F.first("capacity").alias("capacity"), F.first(per).alias("per"), F.array_sort(F.collect_list(piece)).alias("x"))
    raw = F.hex(F.aggregate("x", F.lit(b""), lambda a, x: F.concat(a, x["ids"])))
    return g.withColumn("raw", raw).select("sequence_id", "capacity", F.col("x.id").alias("doc_ids"), F.expr(
        "transform(sequence(0L, length(raw) div (2 * per) - 1), k -> CAST(conv(array_join(reverse(regexp_extract_all("
        "substring(raw, int(k * 2 * per) + 1, int(2 * per)), '..', 0)), ''), 16, 10) AS INT))").alias("ids"))
