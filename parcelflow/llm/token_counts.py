"""Token counts by a finite-state tokenizer.

The merges of a byte-pair vocabulary are compiled, lazily, into a deterministic
transducer over the symbols of a word. Its states rest on two facts about
byte-pair encoding: a sequence of tokens is an encoding exactly when every two
neighbours are the encoding of their own concatenation, and every prefix of an
encoding is one. So the encoding of a word read so far is a chain in which each
place has one last token, and a token can end here only if it follows the last
token of the place where it began. A state is the set of the places where a
longer token may still begin, each with its trie node, its last token and its
token count relative to the place reached. A transition reads one symbol, finds
the one token that ends there and emits the change in the number of tokens; the
transition on a word's closing symbol emits the last of them. States and
transitions that occur are kept in tables, like a lazy DFA's; when these are
full they are built anew.

Texts are cut into chunks. A chunk's map tells what it does to any state it is
entered in: the symbols up to its first white space continue the word that was
open, those after its last white space open a new one, and all between is a
number, since every state meets at white space. Such maps compose
associatively, so the chunks of one text are mapped in parallel and combined by
a prefix scan over their numbers.

Defined results: null and empty texts have no token; repeated rows are counted
alike; extra columns are carried through by ``count_tokens``. Working columns
start with ``_t_``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, table
from .tokens import tokenizer_path
from .worker import keep

LIMIT = 2048
#: Bytes of a chunk, about; a text is cut at any byte.
CHUNK_BYTES = 1 << 16
#: States, word counts and pair answers a worker keeps before it starts anew.
MAX_STATES, MAX_WORDS, MAX_PAIRS = 150_000, 400_000, 500_000
SPACE = re.compile(rb"[\x20\x09-\x0D]")


# ---- the transducer ---------------------------------------------------------

class Transducer:
    """Number of tokens of a word, by transitions over its symbols."""

    def __init__(self, vocabulary: dict[str, int], merges: list, end: str, max_states: int = MAX_STATES):
        self.end, self.max_states = end, max_states
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank = {p: k for k, p in enumerate(pairs)}
        self.pair_ok: dict[tuple, bool] = {}
        # Trie over symbols; a word's last symbol is the letter and ``end`` together.
        self.child: list[dict[str, int]] = [{}]
        self.token: list[tuple | None] = [None]
        for t in vocabulary:
            symbols = self.symbols(t)
            if self.encode(symbols) != [t]:
                continue                                                        # no merges lead to it
            node = 0
            for s in symbols:
                nxt = self.child[node].get(s)
                if nxt is None:
                    nxt = self.child[node][s] = len(self.child)
                    self.child.append({})
                    self.token.append(None)
                node = nxt
            self.token[node] = (t,)
        self.clear()

    def clear(self) -> None:
        start = ((0, None, 0),)
        self.states, self.number = [start], {start: 0}
        self.step: list[dict[str, tuple[int, int]]] = [{}]

    def symbols(self, t: str) -> list[str]:
        if self.end and t.endswith(self.end) and t != self.end:
            body = t[:-len(self.end)]
            return [*body[:-1], body[-1] + self.end] if body else [t]
        return list(t)

    def encode(self, symbols: list[str]) -> list[str]:
        """Plain byte-pair encoding: the lowest-ranked pair first, leftmost first."""
        parts = list(symbols)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: self.rank.get((parts[k], parts[k + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def follows(self, a: str, b: str) -> bool:
        """Whether tokens a, b are the encoding of their concatenation."""
        ok = self.pair_ok.get((a, b))
        if ok is None:
            if len(self.pair_ok) > MAX_PAIRS:
                self.pair_ok.clear()
            ok = self.pair_ok[a, b] = self.encode(self.symbols(a) + self.symbols(b)) == [a, b]
        return ok

    def _read(self, state: tuple, symbol: str, closing: bool):
        """The token that ends with ``symbol``, its count relative to the place
        before, and the places that stay open."""
        found, still = None, []
        for node, last, count in state:
            nxt = self.child[node].get(symbol)
            if nxt is None:
                continue
            token = self.token[nxt]
            if token and found is None and (last is None or self.follows(last, token[0])):
                found = (token[0], count + 1)
            if not closing and self.child[nxt]:
                still.append((nxt, last, count))
        if found is None:
            raise ValueError(f"no token ends with {symbol!r}")
        return found, still

    def _transition(self, state: int, symbol: str, closing: bool) -> tuple[int, int]:
        (token, emitted), still = self._read(self.states[state], symbol, closing)
        if closing:
            nxt = (0, emitted)
        else:
            # Counts are kept relative to the place reached, so equal futures are one state.
            new = tuple((n, t, c - emitted) for n, t, c in still) + ((0, token, 0),)
            k = self.number.get(new)
            if k is None:
                k = self.number[new] = len(self.states)
                self.states.append(new)
                self.step.append({})
            nxt = (k, emitted)
        self.step[state][symbol] = nxt
        return nxt

    def count(self, word: str) -> int:
        """Tokens of a word (its symbols without the end mark)."""
        if len(self.states) > self.max_states:
            self.clear()
        step, state, total = self.step, 0, 0
        for s in word[:-1]:
            nxt = step[state].get(s) or self._transition(state, s, False)
            state = nxt[0]
            total += nxt[1]
        s = word[-1] + self.end
        nxt = step[state].get(s) or self._transition(state, s, True)
        return total + nxt[1]


class Counter(dict):
    """Piece without ASCII white space -> its number of tokens."""

    ASCII = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    CONTROL = re.compile("[\x00-\x20\x7f]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        model = parts["model"]
        # The rules of the file's own normaliser and splitter are the library's; the merges are compiled here.
        rules = Tokenizer.from_file(path)
        self.normal, self.split = rules.normalizer, rules.pre_tokenizer
        special = sorted((t["content"] for t in parts["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.transducer = Transducer(model["vocab"], model["merges"], model["end_of_word_suffix"])

    def __missing__(self, piece: bytes) -> int:
        text = piece.decode("utf-8")
        n = 0
        if self.special and self.special.search(text):
            n += len(self.special.findall(text))                 # one token each
            n += sum(self._count(x) for x in self.special.split(text) if x)
        else:
            n += self._count(text)
        if len(self) >= MAX_WORDS:
            self.clear()
        self[piece] = n
        return n

    def _count(self, text: str) -> int:
        count = self.transducer.count
        if text.isascii() and not self.CONTROL.search(text):
            return sum(map(count, self.ASCII.findall(text.lower())))
        units = self.split.pre_tokenize_str(self.normal.normalize_str(text))
        return sum(count(u) for u, _ in units if u)

    def chunk(self, data: bytes) -> tuple[bytes, int, bytes, bool]:
        """State map of a chunk: symbols that continue the open word, tokens of
        the words between, symbols of the word left open, and whether the chunk
        has white space at all (if not, all its symbols are in the first)."""
        first = SPACE.search(data)
        if not first:
            return data, 0, b"", False
        cut = first.start()
        last = len(data) if SPACE.match(data[-1:]) else len(data) - len(SPACE.split(data[-4096:])[-1])
        if last <= len(data) - 4096:
            last = max(data.rfind(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")) + 1
        return data[:cut], sum(map(self.__getitem__, data[cut:last].split())), data[last:], True


def _counter(path: str) -> Counter:
    return keep(("counts", path), lambda: Counter(path))


# ---- composition of chunk maps ----------------------------------------------

def compose(a: tuple, b: tuple, closed) -> tuple:
    """The map of two neighbouring chunks; ``closed`` counts a whole word."""
    (ha, na, ta, sa), (hb, nb, tb, sb) = a, b
    if not sa:
        return (ha + hb, nb, tb, sb)
    if not sb:
        return (ha, na, ta + hb, True)
    return (ha, na + nb + (closed(ta + hb) if ta or hb else 0), tb, True)


def finish(m: tuple, closed) -> int:
    """Tokens of a whole text, entered and left between words."""
    head, n, tail, _ = m
    return n + sum(closed(x) for x in (head, tail) if x)


def total(maps: list[tuple], closed) -> tuple:
    """Composition of all maps in order, by rounds of independent neighbours;
    a round holds no more symbols than the one before."""
    while len(maps) > 1:
        maps = [compose(maps[k], maps[k + 1], closed) if k + 1 < len(maps) else maps[k] for k in range(0, len(maps), 2)]
    return maps[0]


# ---- over all documents -----------------------------------------------------

MAP = "head binary, tokens long, tail binary, spaced boolean"


def _mapper(path: str):
    schema = pa.schema([("_t_row", pa.int64()), ("_t_chunk", pa.int32()), ("head", pa.binary()), ("tokens", pa.int64()), ("tail", pa.binary()), ("spaced", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _counter(path)
        for batch in batches:
            maps = [c.chunk(x) for x in batch.column(2).cast(pa.binary()).to_pylist()]
            cols = list(zip(*maps)) if maps else [[], [], [], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, f.type) for x, f in zip(cols, list(schema)[2:])]], schema=schema)

    return run


def _whole(path: str, columns: list[str]):
    """Counts of texts of one chunk, beside their own columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = _counter(path)
        closed = c.__getitem__
        for batch in batches:
            at = batch.schema.get_field_index("_t_data")
            n = [finish(c.chunk(x), closed) for x in batch.column(at).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in columns], pa.array(n, pa.int64())], names=[*columns, "_t_n"])

    return run


def _folder(path: str):
    """Count of a text from the maps of its chunks, in order."""
    @F.pandas_udf("long")
    def fold(maps: pd.Series) -> pd.Series:
        c = _counter(path)
        closed = c.__getitem__
        return pd.Series([finish(total([(bytes(m["head"]), int(m["tokens"]), bytes(m["tail"]), bool(m["spaced"])) for m in ms], closed), closed) for ms in maps])

    return fold


def count_tokens(docs: DataFrame, path: str, text: str = "text", out: str = "n_tokens", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` with the number of tokens of ``text``.

    A text of one chunk is counted where it is. A longer one is cut; its chunks
    are mapped in parallel, wherever they land, and their small maps brought
    together and composed. A given column of the result's name is replaced.
    """
    docs = docs.drop(out) if out != text else docs
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    src = docs.withColumn("_t_data", data)
    short = src.where(F.octet_length("_t_data") <= chunk_bytes)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    one = short.mapInArrow(_whole(path, docs.columns), ", ".join([*kinds, "_t_n long"]))
    long_ = src.where(F.octet_length("_t_data") > chunk_bytes)
    long_ = long_.select(*docs.columns, F.col("_t_data"), F.monotonically_increasing_id().alias("_t_row"))
    long_ = stored(long_, "token-long-texts")
    starts = F.sequence(F.lit(0).cast("long"), ((F.octet_length("_t_data") - 1) / chunk_bytes).cast("long"))
    chunk = long_.select("_t_row", "_t_data", F.explode(starts).alias("k")).select(
        "_t_row", F.col("k").cast("int").alias("_t_chunk"), F.substring("_t_data", (F.col("k") * chunk_bytes + 1).cast("int"), F.lit(chunk_bytes)).alias("_t_part"))
    maps = chunk.repartition("_t_row", "_t_chunk").mapInArrow(_mapper(path), f"_t_row long, _t_chunk int, {MAP}")
    by = maps.groupBy("_t_row").agg(F.array_sort(F.collect_list(F.struct("_t_chunk", "head", "tokens", "tail", "spaced"))).alias("m"))
    counted = by.select("_t_row", _folder(path)("m").alias("_t_n"))
    many = long_.drop("_t_data").join(counted, "_t_row").select(*docs.columns, "_t_n")
    return one.unionByName(many).withColumnRenamed("_t_n", out)


def over_limit(n: Column, limit: int = LIMIT) -> Column:
    return n > limit


# ---- registered query -------------------------------------------------------

def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").select(
        "doc_id", "text", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"))
    return count_tokens(docs, tokenizer_path()).select("doc_id", "n_bytes", "n_tokens", over_limit(F.col("n_tokens")).alias("over_limit"))
