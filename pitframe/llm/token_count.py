"""Token counts by a compiled finite-state transducer over byte-pair symbols.

The tokenizer's merges are compiled into a deterministic transducer. Reading a pre-token symbol by
symbol, the encoding of every prefix ends in one token, and a token may follow another exactly if the
two, merged together, stay as they are. A state is the set of prefixes that a token may still grow
from: (place in the token trie, last token before it, tokens so far over the state's least). A
transition adds a symbol and is annotated with the tokens that are now certain. States and
transitions are made when first met and kept.

Texts are cut into chunks of whole code points. A chunk's map is (leading part up to the first white
space, tokens in between, trailing part, whether there was white space): what it does to any state it
is entered in. Maps compose associatively; a prefix scan in pairs joins the chunks of a long text, so
one text is counted by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitframe.llm.common import text_hash
from pitframe.llm.tokens import PieceCache, library

CHUNK = 1 << 16  # characters
ROOT = 0
END = "</w>"
SPACE = b" \t\n\r\x0b\x0c"


class Transducer:
    """Counts the tokens of one pre-token in byte letters, for merges with word ends."""

    def __init__(self, merges: list[tuple[str, str]], most_states: int = 150_000):
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.most_states = most_states
        self.kids: list[dict[str, int]] = [{}]
        self.token: list[tuple[str, ...] | None] = [None]
        self.follow: dict[tuple[str, str], bool] = {}
        for left, right in merges:
            self._grow(self.symbols(left + right), left + right)
        self.reset()

    @staticmethod
    def symbols(token: str) -> list[str]:
        if token.endswith(END) and len(token) > len(END):
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def _grow(self, symbols: list[str], token: str) -> None:
        at = ROOT
        for s in symbols:
            nxt = self.kids[at].get(s)
            if nxt is None:
                nxt = self.kids[at][s] = len(self.kids)
                self.kids.append({})
                self.token.append(None)
            at = nxt
        if self.merged(symbols) == [token]:  # a token that its own text isn't merged to never comes out
            self.token[at] = token

    def merged(self, parts: list[str]) -> list[str]:
        """Byte-pair merging as defined: the lowest-ranked pair first, leftmost first."""
        parts = list(parts)
        while len(parts) > 1:
            low = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            pair = (parts[low], parts[low + 1])
            if pair not in self.rank:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def reset(self) -> None:
        self.states: list[tuple] = [((ROOT, "", 0),)]
        self.ids: dict[tuple, int] = {self.states[0]: 0}
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def may_follow(self, left: str, right: str) -> bool:
        if not left:
            return True
        got = self.follow.get((left, right))
        if got is None:
            if len(self.follow) > 2_000_000:
                self.follow.clear()
            got = self.follow[left, right] = self.merged(self.symbols(left) + self.symbols(right)) == [left, right]
        return got

    def compile(self, state: int, symbol: str) -> tuple[int, int]:
        """The transition of a state under a symbol: (next state, tokens emitted)."""
        alive, last, n = [], symbol, -1
        for node, before, count in self.states[state]:
            nxt = self.kids[node].get(symbol)
            if nxt is not None:
                token = self.token[nxt]
                if token is not None and self.may_follow(before, token):
                    last, n = token, count + 1
                if self.kids[nxt]:
                    alive.append((nxt, before, count))
        if n < 0:  # the symbol on its own, also where no merge has it
            n = next(c for node, _, c in self.states[state] if node == ROOT) + 1
        if symbol.endswith(END):
            got = (0, n)
        else:
            alive.append((ROOT, last, n))
            base = min(x[2] for x in alive)
            key = tuple((a, b, c - base) for a, b, c in alive)
            to = self.ids.get(key)
            if to is None:
                to = self.ids[key] = len(self.states)
                self.states.append(key)
                self.moves.append({})
            got = (to, base)
        self.moves[state][symbol] = got
        return got

    def count(self, piece: str) -> int:
        if len(self.states) > self.most_states:
            self.reset()
        state, n, moves = 0, 0, self.moves
        for symbol in piece[:-1]:
            got = moves[state].get(symbol)
            state, add = self.compile(state, symbol) if got is None else got
            n += add
        symbol = piece[-1] + END
        got = moves[state].get(symbol)
        return n + (self.compile(state, symbol) if got is None else got)[1]


@lru_cache(maxsize=2)
def counter(name: str) -> PieceCache:
    """One per worker process: the compiled transducer behind a cache of pre-tokens."""
    import json

    import public_tokenizers
    tok = library(name)
    with open(public_tokenizers.path(name), encoding="utf-8") as f:  # installed on every executor with its library
        merges = json.load(f)["model"]["merges"]
    fst = Transducer([tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges])
    return PieceCache(fst.count, lambda word: len(tok.encode(word, add_special_tokens=False).ids))


def chunk_map(text: str, count: PieceCache) -> tuple[bytes, int, bytes, bool]:
    """(leading part, tokens between, trailing part, has white space) of a chunk."""
    raw = text.encode()
    head_end = len(raw) - len(raw.lstrip(SPACE))
    first = next((i for i in range(head_end, len(raw)) if raw[i] in SPACE), -1) if head_end == 0 else 0
    if first < 0:
        return raw, 0, b"", False
    body = raw[first:]
    keep = len(body.rstrip(SPACE))
    if keep < len(body):
        return raw[:first], sum(count.values(body.decode())), b"", True
    cut = max(body.rfind(s) for s in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")) + 1
    return raw[:first], sum(count.values(body[:cut].decode())), body[cut:], True


def compose(a: tuple, b: tuple, count: PieceCache) -> tuple:
    """First chunk ``a``, then ``b``: the word across the cut is closed if either side ends it."""
    if not a[3] and not b[3]:
        return a[0] + b[0], 0, b"", False
    if not a[3]:
        return a[0] + b[0], b[1], b[2], True
    if not b[3]:
        return a[0], a[1], a[2] + b[0], True
    return a[0], a[1] + b[1] + sum(count.values((a[2] + b[0]).decode())), b[2], True


def scan(maps: list[tuple], count: PieceCache) -> int:
    """Tokens of the composed chunks, composed in pairs."""
    while len(maps) > 1:
        maps = [compose(*maps[i:i + 2], count) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    head, n, tail, _ = maps[0]
    return n + sum(count.values(head.decode())) + sum(count.values(tail.decode()))


def token_counts(docs: DataFrame, name: str = "word_bpe_49k.json", id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row, as the library counts them without added special tokens.

    Null texts are empty: no bytes, no tokens. Texts longer than a chunk are cut and spread over
    tasks; repeated rows and null ids come out as often as they came in.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("th"), F.octet_length(text).cast("long").alias("n_bytes"), F.greatest(F.lit(1), F.ceil(F.length(text) / chunk)).cast("long").alias("n_chunks"), text.alias("text"))
    short = rows.filter("n_chunks = 1")
    long = rows.filter("n_chunks > 1").withColumn("chunk", F.explode(F.sequence(F.lit(1), F.col("n_chunks"))))
    long = long.withColumn("text", F.substring("text", ((F.col("chunk") - 1) * chunk + 1).cast("int"), F.lit(chunk)))

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(name)
        for x in batches:
            yield pd.DataFrame({"id": x["id"], "n_bytes": x["n_bytes"], "n_tokens": [sum(count.values(t)) for t in x["text"]]})

    def parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(name)
        for x in batches:
            maps = [chunk_map(t, count) for t in x.pop("text")]
            yield x.assign(**{c: [m[i] for m in maps] for i, c in enumerate(("head", "between", "tail", "space"))})

    def join(x: pd.DataFrame) -> pd.DataFrame:
        count, x = counter(name), x.sort_values("chunk")
        copies = int((x["chunk"] == 1).sum())
        one = x.drop_duplicates("chunk")
        n = scan(list(zip(map(bytes, one["head"]), one["between"].astype(int), map(bytes, one["tail"]), one["space"], strict=True)), count)
        return x.head(1)[["id", "n_bytes"]].assign(n_tokens=n).loc[lambda d: d.index.repeat(copies)]

    out = f"id {kind}, n_bytes long, n_tokens long"
    direct = short.select("id", "n_bytes", "text").mapInPandas(whole, out)
    spread = long.select("id", "th", "n_bytes", "chunk", "text").repartition("id", "th", "chunk").mapInPandas(parts, f"id {kind}, th long, n_bytes long, chunk long, head binary, between long, tail binary, space boolean")
    return direct.unionByName(spread.groupBy("id", "th").applyInPandas(join, out))
