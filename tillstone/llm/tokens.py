"""Token counts by a tokenizer compiled to a deterministic transducer.

The tokenizer is a BPE piece model: neighbouring symbols are merged by score as
long as the merged text is a piece. Which token ends at a place depends only on
the tokens that end at the places just before it, so a state is that window,
and reading a character leads to one next state. The transition is annotated
with how many tokens it adds (it can be none, or less, where tokens merge).
States are built when they are first reached and forgotten when too many.

A text is cut into chunks, which are read apart from each other. A chunk's map
gives for an entering state the tokens that it adds and the state it leaves
behind. Where a blank follows another character every state falls back to the
start, so a chunk with such a place shortly before it has one entering state.
Elsewhere (long runs without blanks) the states that reading may have come to
are found by starting at several places before the chunk, and mostly become one
at once. Maps compose in any grouping; a scan over a text's chunks gives its
count. A text that enters a chunk in a state its map does not have is read anew
from end to end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstone.llm.common import let, same, settle, whole

#: What the model puts in place of a blank, and before a text.
SPACE = "▁"
NEVER = float("-inf")
#: The entering state of a map that holds for whatever comes before.
ANY = ""
#: Entering state -> (tokens, leaving state); states by their digest.
Map = dict[str, tuple[int, str]]


@dataclass(frozen=True)
class Counting:
    """``model`` is the path of the piece model, ``chunk`` the characters of a chunk, ``limit`` the tokens a document
    may have. A chunk comes with the ``before`` characters in front of it; reading starts at the first ``phases`` of
    them if there is no place to cut. Chunks of texts of more than ``deal`` characters go to other tasks. ``states`` and
    ``units`` bound what a task remembers; what is forgotten is built again."""

    model: str = public_tokenizers.path("piece_bpe_32k.model")
    chunk: int = 16_384
    limit: int = 4096
    before: int = 192
    phases: int = 16
    deal: int = 262_144
    states: int = 200_000
    units: int = 300_000


class State:
    """The places where a piece that is not complete yet may have begun, the earliest first, up to the present one.

    Each with the characters read since, the token that ends there (None: the
    start) and the tokens up to there, relative to the present place.
    """

    __slots__ = ("places", "next")

    def __init__(self, places: tuple[tuple[str, str | None, int], ...]):
        self.places, self.next = places, {}


class Transducer:
    """Counts the tokens of texts as the piece model gives them."""

    def __init__(self, how: Counting):
        model = sentencepiece.SentencePieceProcessor(model_file=how.model)
        self.how = how
        self.scores = {
            model.id_to_piece(i): model.get_score(i)
            for i in range(model.vocab_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        if any(SPACE in p.lstrip(SPACE) for p in self.scores):
            raise ValueError("a piece has a blank after another character, so texts cannot be cut at blanks")
        self.prefixes = {p[:i] for p in self.scores for i in range(1, len(p))}
        self.fits: dict[tuple[str, str], bool] = {}
        self.units: dict[str, int] = {}
        self.forget()

    def forget(self) -> None:
        self.start = State((("", None, 0),))
        self.known = {self.start.places: self.start}

    def merged(self, text: str) -> list[str]:
        """The symbols of a short text: the neighbours of highest score merge first, the leftmost of equals."""
        score, symbols = self.scores.get, list(text)
        pairs = [score(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
        while pairs and (best := max(pairs)) > NEVER:
            i = pairs.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = score(symbols[i - 1] + symbols[i], NEVER)
            if i < len(pairs):
                pairs[i] = score(symbols[i] + symbols[i + 1], NEVER)
        return symbols

    def adjacent(self, before: str | None, token: str) -> bool:
        """Whether ``token`` can follow ``before`` in a tokenized text (None: begin it)."""
        key = (before or "", token)
        fits = self.fits.get(key)
        if fits is None:
            if len(self.fits) > 2 * self.how.units:
                self.fits.clear()
            # A piece that merging does not give by itself never comes after another one either.
            able = before is None or self.adjacent(None, token)
            fits = self.fits[key] = able and self.merged("".join(key)) == [t for t in key if t]
        return fits

    def weight(self, token: str) -> int:
        """Tokens that a symbol comes to: one for a piece, else one for each byte."""
        return 1 if token in self.scores else len(token.encode("utf-8", "surrogatepass"))

    def step(self, state: State, char: str) -> tuple[State, int]:
        """The state after ``char`` and the tokens that it adds."""
        for read, before, count in state.places:
            token = read + char
            if (not read or token in self.scores) and self.adjacent(before, token):
                break
        else:
            raise ValueError(f"no token ends after {token!r}")
        added = count + self.weight(token)
        places = [(r + char, t, n - added) for r, t, n in state.places if r + char in self.prefixes]
        places = (*places, ("", token, 0))
        if len(self.known) > self.how.states:
            self.forget()
        found = self.known.get(places)
        if found is None:
            found = self.known[places] = State(places)
        state.next[char] = found, added
        return found, added

    def read(self, state: State, text: str) -> tuple[State, int]:
        """The state after ``text`` and the tokens that it adds."""
        total = 0
        for char in text:
            state, added = state.next.get(char) or self.step(state, char)
            total += added
        return state, total

    def unit(self, text: str) -> int:
        """The tokens of a text without a place to cut."""
        return self.read(self.start, text)[1]

    def count(self, text: str) -> int:
        """The tokens of a text in which SPACE stands for blanks."""
        if not text:
            return 0
        parts, total, units = text.split(SPACE), 0, self.units
        if parts[0]:
            total = self.unit(parts[0])
        blanks = 0
        for part in parts[1:]:
            blanks += 1
            if part:
                n = units.get(part) if blanks == 1 else None
                if n is None:
                    n = self.unit(SPACE * blanks + part)
                    if blanks == 1 and len(part) < 64:
                        if len(units) > self.how.units:
                            units.clear()
                        units[part] = n
                total += n
                blanks = 0
        return total + (self.unit(SPACE * blanks) if blanks else 0)

    def entering(self, before: str) -> dict[str, State]:
        """The states in which a chunk may be entered after ``before``; only one, for ANY, if it is sure."""
        if not before:
            return {ANY: self.start}
        cut = last_cut(before)
        if cut is not None:
            return {ANY: self.read(self.start, before[cut:])[0]}
        states = (self.read(self.start, before[i:])[0] for i in range(min(self.how.phases, len(before))))
        return {digest(s): s for s in states}

    def chunk_map(self, before: str, text: str) -> Map:
        """What a chunk does to the states in which it may be entered; ``before`` is empty for the first one."""
        edge = before[-1:]
        first = next(cuts(edge + text), None)
        if first is None:
            read = {name: self.read(state, text) for name, state in self.entering(before).items()}
            return {name: (tokens, digest(leaving)) for name, (leaving, tokens) in read.items()}
        first, last = first - len(edge), last_cut(edge + text) - len(edge)
        leaving, tail = self.read(self.start, text[last:])
        tokens, left = self.count(text[first:last]) + tail, digest(leaving)
        if not first:
            return {ANY: (tokens, left)}
        return {name: (self.read(state, text[:first])[1] + tokens, left) for name, state in self.entering(before).items()}


def compose(x: Map, y: Map) -> Map:
    """First ``x``, then ``y``; without the states that lead to one that ``y`` does not have."""
    both = {}
    for name, (tokens, leaving) in x.items():
        on = y.get(leaving) or y.get(ANY)
        if on:
            both[name] = tokens + on[0], on[1]
    return both


def scan(maps: list[Map]) -> int | None:
    """The tokens of a text from its chunks' maps, put together two by two; None if a state on the way is unknown."""
    while len(maps) > 1:
        pairs = [compose(*maps[i : i + 2]) for i in range(0, len(maps) - 1, 2)]
        maps = pairs + maps[len(pairs) * 2 :]
    return maps[0][ANY][0] if ANY in maps[0] else None


def digest(state: State) -> str:
    return hashlib.blake2b(repr(state.places).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def cuts(text: str) -> Iterator[int]:
    """The places where a blank follows another character."""
    at = text.find(SPACE, 1)
    while at > 0:
        if text[at - 1] != SPACE:
            yield at
        at = text.find(SPACE, at + 1)


def last_cut(text: str) -> int | None:
    """The last of the places where a blank follows another character."""
    at = text.rfind(SPACE)
    while at > 0:
        if text[at - 1] != SPACE:
            return at
        at = text.rfind(SPACE, 0, at)
    return None


def marked(text: str, first: bool) -> str:
    """``text`` with SPACE for blanks, and one before a text that is not empty."""
    return (SPACE if first and text else "") + text.replace(" ", SPACE)


def chunks_of(docs: DataFrame, how: Counting) -> DataFrame:
    """(row, doc_id, text_hash, n_bytes, far, i, before, text): the chunks of every text, at least one; those of long texts dealt over the tasks."""
    text = whole("text")
    pieces = F.when(text == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{how.chunk}}}"), F.lit(0)))
    chunks = let(
        pieces,
        lambda all_: F.transform(
            all_,
            lambda x, i: F.struct(
                i.alias("i"), F.when(i > 0, F.substring(F.get(all_, i - 1), -how.before, how.before)).otherwise("").alias("before"), x.alias("text")
            ),
        ),
    )
    # The number is given before the chunks are laid out, so all chunks of a row have it.
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def of(far: bool) -> DataFrame:
        these = rows.filter((F.length(text) > how.deal) if far else (F.length(text) <= how.deal))
        size = F.octet_length(text).cast("long").alias("n_bytes")
        return these.select("row", "doc_id", "text_hash", size, F.lit(far).alias("far"), F.inline(chunks))

    return of(False).union(of(True).repartition("row", "i"))


def count_tokens(docs: DataFrame, how: Counting = Counting()) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``.

    NULL and empty texts have no bytes and no tokens. Repeated rows are counted
    one by one. Strings of special tokens inside a text are ordinary text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = f"row long, doc_id {kind}, text_hash long, n_bytes long"
    own = ["row", "doc_id", "text_hash", "n_bytes", "far"]

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = None
        for batch in batches:
            machine = machine or Transducer(how)
            found = [machine.chunk_map(marked(b, False), marked(t, i == 0)) for i, b, t in zip(batch["i"], batch["before"], batch["text"])]
            entries = [[(name, tokens, leaving) for name, (tokens, leaving) in m.items()] for m in found]
            yield batch[[*own, "i"]].assign(entries=entries)

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = [scan([{e["name"]: (e["tokens"], e["leaving"]) for e in m["entries"]} for m in ms]) for ms in batch["maps"]]
            yield batch[["doc_id", "text_hash", "n_bytes"]].assign(n_tokens=pd.array(n, "Int64"))

    def anew(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = None
        for batch in batches:
            machine = machine or Transducer(how)
            yield batch[["a_id", "a_hash"]].assign(anew=[machine.count(marked(t, True)) for t in batch["text"]])

    entry = "array<struct<name: string, tokens: long, leaving: string>>"
    mapped = chunks_of(docs, how).mapInPandas(maps, f"{base}, far boolean, i int, entries {entry}")
    ordered = mapped.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("i", "entries"))).alias("maps"))
    counted = settle(ordered.mapInPandas(totals, f"doc_id {kind}, text_hash long, n_bytes long, n_tokens long"), "token-counts")
    missed = counted.filter("n_tokens is null").select(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash")).distinct()
    if not missed.isEmpty():
        texts = docs.select(F.col("doc_id").alias("a_id"), F.xxhash64("text").alias("a_hash"), "text")
        texts = texts.join(missed, same(F.col("a_id"), F.col("m_id")) & (F.col("a_hash") == F.col("m_hash")), "left_semi")
        read = settle(texts.dropDuplicates(["a_id", "a_hash"]).mapInPandas(anew, f"a_id {kind}, a_hash long, anew long"), "token-anew")
        counted = counted.join(read, same(F.col("doc_id"), F.col("a_id")) & (F.col("text_hash") == F.col("a_hash")), "left")
        counted = counted.withColumn("n_tokens", F.coalesce("n_tokens", "anew"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > how.limit).alias("over_limit"))


def op2(docs: DataFrame) -> DataFrame:
    return count_tokens(docs)
