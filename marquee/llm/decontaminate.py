"""Benchmark questions in documents, also with other numbers, names and units in them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import mixed, slices, windows
from marquee.session import cut_lineage, fits_broadcast

WINDOW = 8
SHORT = 5  # items of fewer tokens are looked for as they are
MOST_CONFLICTS = 0.25  # share of the slot values on a diagonal that may stand for a second value
FILTER_BITS = 24

# Words that are units; a number before or inside the word is its own slot
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds lb lbs oz ounce ounces ton tons tonne tonnes "
    "ml cl l liter liters litre litres gallon gallons quart quarts pint pints cup cups second seconds sec minute minutes min hour hours hr hrs day days week weeks "
    "month months year years meter meters metre metres centimeter centimeters centimetre centimetres millimeter millimeters kilometer kilometers kilometre kilometres "
    "dollar dollars cent cents euro euros usd eur gbp percent degree degrees celsius fahrenheit mph kph km/h watt watts kw kwh volt volts amp amps joule joules "
    "calorie calories hz khz mhz ghz byte bytes kb mb gb tb".split()
)
# Words that are numbers, also joined by hyphens
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half".split()
)
EDGES = ".,;:!?\"'()[]{}<>|*#&~`^_=\\…“”‘’«»¿¡"
NUMBER = re.compile(r"[-+]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th)?%?")
MEASURE = re.compile(r"[-+]?\d[\d.,]*-?([a-z]+(?:/h)?)")
NONE, NUMERIC, UNIT, NAME = range(4)
LINES = re.compile(r"[\n\r\x0b\x0c]+")
SENTENCES = re.compile(r"[.!?]+(?=\s|$)")
VERBATIM = 2  # the form of short items; forms 0 and 1 have names as words and as slots


def slot_of(token: str) -> int:
    """Which placeholder a token, stripped of signs, gets."""
    low = token.lower()
    if NUMBER.fullmatch(low) or ((m := MEASURE.fullmatch(low)) and m[1] in UNITS) or all(w in NUMBER_WORDS for w in low.split("-")):
        return NUMERIC
    if low in UNITS:
        return UNIT
    return NAME if token[0].isupper() and not token.isupper() else NONE


class _Lexicon:
    """Words by number: hash with numbers and units replaced, with names replaced too, with nothing replaced; slot, and plain form."""

    LIMIT = 150_000

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.plain: list[int] = []
        self.named: list[int] = []
        self.own: list[int] = []
        self.slots: list[int] = []
        self.forms: list[str] = []

    def add(self, word: str) -> int:
        token = word.strip(EDGES)
        slot = slot_of(token) if token else NONE
        low = token.lower()
        own = xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass")) if token else 0
        kind = xxhash.xxh64_intdigest(b"\0slot", slot)
        self.plain.append(kind if slot in (NUMERIC, UNIT) else own)
        self.named.append(kind if slot else own)
        self.own.append(own)
        self.slots.append(slot)
        self.forms.append(low)
        self.numbers[word] = len(self.numbers)
        return self.numbers[word]

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts one after the other, without words of signs only, and how many of each text."""
        if len(self.numbers) > self.LIMIT:
            self.clear()
        get, add = self.numbers.get, self.add
        found = []
        for text in texts:
            words = text.split() if text else []
            row = list(map(get, words))
            if None in row:
                for k, n in enumerate(row):
                    if n is None:
                        n = get(words[k])
                        row[k] = add(words[k]) if n is None else n
            found.append(np.array(row, np.int64))
        plain = np.array(self.plain, np.uint64)
        found = [r[plain[r] != 0] if len(r) else r for r in found]
        return (np.concatenate(found) if found else np.zeros(0, np.int64)), np.array([len(r) for r in found], np.int64)


def _windows_at(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows that begin at ``starts``."""
    out = np.full(len(starts), np.uint64(size + 1), np.uint64)
    for k in range(size):
        out = mixed(out + mixed(hashes[starts + k] + np.uint64(k)))
    return out


def _units(text: str) -> Iterator[str]:
    """The lines of a text, and the sentences of those that have several."""
    for line in LINES.split(text):
        yield line
        parts = SENTENCES.split(line)
        if sum(map(bool, map(str.strip, parts))) > 1:
            yield from parts


def _short_hits(lexicon: _Lexicon, texts: list[str | None], sizes: list[int], wanted: np.ndarray | None) -> Iterator[tuple[int, int, int, np.ndarray, list[list[str]]]]:
    """Lines and sentences of as many tokens as short items have, like ``_hits``; whole texts where ``wanted`` is None."""
    shift = np.uint64(64 - FILTER_BITS)
    for k, text in enumerate(texts):
        seen = set()
        for unit in (text,) if wanted is None else _units(text or ""):
            if not unit or unit in seen or (wanted is not None and len(unit.split(None, 4 * SHORT)) >= 4 * SHORT):
                continue
            seen.add(unit)
            numbers, count = lexicon.read([unit])
            size = int(count[0])
            if size not in sizes:
                continue
            h = _windows_at(np.array([lexicon.own[n] for n in numbers], np.uint64), np.zeros(1, np.int64), size)
            if wanted is None or wanted[h >> shift][0]:
                yield k, VERBATIM, size, h.view(np.int64), [[]]


def _hits(lexicon: _Lexicon, texts: list[str | None], sizes: list[int], wanted: np.ndarray | None) -> Iterator[tuple[int, int, int, np.ndarray, list[list[str]]]]:
    """Runs of windows that the filter lets through: (text, form, size, hashes, fillers of each window).

    Form 0 has names as words, form 1 as slots. A window of more slots than words is hashed with their values, as it
    would else be like every list of numbers or names. ``wanted`` None lets everything through.
    """
    numbers, counts = lexicon.read(texts)
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(numbers)) - np.repeat(ends - counts, counts)
    slots = np.array(lexicon.slots, np.int8)[numbers] if len(numbers) else np.zeros(0, np.int8)
    shift = np.uint64(64 - FILTER_BITS)
    own = np.array(lexicon.own, np.uint64)[numbers] if len(numbers) else np.zeros(0, np.uint64)
    for form, hashes in ((0, lexicon.plain), (1, lexicon.named)):
        tokens = np.array(hashes, np.uint64)[numbers] if len(numbers) else np.zeros(0, np.uint64)
        is_slot = (slots == NUMERIC) | (slots == UNIT) | ((slots == NAME) & (form == 1))
        before = np.r_[0, np.cumsum(is_slot)]
        for size in sizes:
            if len(tokens) < size:
                continue
            h = windows(tokens, size)
            filled = np.flatnonzero(2 * (before[size:] - before[:-size]) > size)
            if len(filled):
                h[filled] = _windows_at(own, filled, size)
            inside = place[: len(h)] + size <= counts[owner[: len(h)]]
            keep = np.flatnonzero(inside if wanted is None else inside & wanted[h >> shift])
            if not len(keep):
                continue
            cut = np.flatnonzero((np.diff(keep) != 1) | (np.diff(owner[keep]) != 0)) + 1
            for run in np.split(keep, cut):
                fillers = [[lexicon.forms[numbers[q]] for q in range(p, p + size) if is_slot[q]] for p in run]
                yield int(owner[run[0]]), form, size, h[run].view(np.int64), fillers


_RUN = pa.list_(pa.struct([("h", pa.int64()), ("fillers", pa.list_(pa.string()))]))
_RUN_DDL = "array<struct<h:bigint,fillers:array<string>>>"


def _find_runs(sizes: list[int], short: list[int], wanted: np.ndarray | None, with_length: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _Lexicon()
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            rows = []
            if with_length:
                for k, text in enumerate(texts):
                    _, count = lexicon.read([text])
                    n = int(count[0])
                    found = _hits(lexicon, [text], [min(WINDOW, n)], None) if n >= SHORT else _short_hits(lexicon, [text], [n], None)
                    rows += [(k, form, size, hs, fillers, n) for _, form, size, hs, fillers in found if n]
            else:
                rows = [(*r, 0) for r in _hits(lexicon, texts, sizes, wanted)]
                if short:
                    rows += [(*r, 0) for r in _short_hits(lexicon, texts, short, wanted)]
            at = pa.array([r[0] for r in rows], pa.int64())
            runs = pa.array([[{"h": int(h), "fillers": f} for h, f in zip(r[3], r[4], strict=True)] for r in rows], _RUN)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(at), *(pa.array([r[k] for r in rows], pa.int32()) for k in (1, 2, 5)), runs], ["id", "form", "size", "tokens", "run"]
            )

    return run


def _covered(positions: Column, size: Column) -> Column:
    return F.size(F.array_distinct(F.flatten(F.transform(positions, lambda p: F.sequence(p, p + size - 1))))).cast("bigint")


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", least: float = 0.6) -> DataFrame:
    """Benchmark items found in documents: (id, item, covered, item_tokens, changed).

    Texts are read as words without signs at their ends. Numbers (in digits, also with a unit, or in words), units and,
    in a second form, capitalised names become typed placeholders. Windows of eight such tokens (the whole item when it
    has five to seven) are joined by hash; a window of more slots than words is joined with its values. Windows on one
    diagonal of a run and an item count when their slots are consistent: a value of the item stands for one value of
    the document, which several may share; at most a quarter of the pairs of values may be a second value of theirs.
    An item of under five tokens is found where it is a whole line or sentence of the document, word for word. Else an item is found when such windows cover at least ``least`` of its tokens; ``changed`` counts slots with
    another value, 0 for a verbatim copy.

    Documents send only windows that pass a filter of 2^24 bits made from the benchmark, whatever the benchmark's
    size, and equal runs of windows are joined once, so a passage that a third of all documents hold is one row in the join. Null
    texts hold nothing and null items are left out; rows with one id are judged together, null ids too; repeated
    items count once; other columns are not read; empty tables give an empty result.
    """
    items = benchmark.select(F.col(item_col).alias("id"), F.col(item_text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    kind = items.schema["id"].dataType.simpleString()
    made = items.mapInArrow(_find_runs([], [], None, with_length=True), f"id {kind}, form int, size int, tokens int, run {_RUN_DDL}")
    made = made.select(F.col("id").alias("item"), "form", "size", "tokens", F.posexplode("run").alias("p", "w")).select("item", "form", "size", "tokens", "p", F.col("w.h").alias("h"), F.col("w.fillers").alias("meant"))
    made = cut_lineage(made.distinct())
    kinds = made.select((F.col("form") == VERBATIM).alias("short"), "size").distinct().collect()  # at most eight
    sizes, short = (sorted(r["size"] for r in kinds if r["short"] == is_short) for is_short in (False, True))
    wanted = np.zeros(1 << FILTER_BITS, bool)
    places = made.select(F.shiftrightunsigned("h", 64 - FILTER_BITS).cast("int").alias("at")).distinct().toPandas()["at"]
    wanted[places.to_numpy(np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(wanted))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _find_runs(sizes, short, np.unpackbits(shared.value).astype(bool))(batches)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(scan, f"id {kind}, form int, size int, tokens int, run {_RUN_DDL}")
    found = cut_lineage(found.select("id", "form", "size", F.sha2(F.to_json("run"), 256).alias("sign"), "run"))
    runs = found.groupBy("form", "size", "sign").agg(F.first("run").alias("run"))
    windows_of = runs.select("form", "size", "sign", F.posexplode("run").alias("o", "w")).select("form", "size", "sign", "o", F.col("w.h").alias("h"), F.col("w.fillers").alias("given"))
    side = F.broadcast(made) if fits_broadcast(made) else made
    pairs = windows_of.join(side, ["form", "size", "h"])
    pairs = pairs.groupBy("form", "size", "sign", "item", "tokens", (F.col("p") - F.col("o")).alias("diagonal")).agg(
        F.collect_set("p").alias("at"), F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("meant", "given")))).alias("slots")
    )
    conflicts = F.size("slots") - F.size(F.array_distinct(F.col("slots.meant")))
    pairs = pairs.filter(conflicts <= MOST_CONFLICTS * F.size("slots"))
    pairs = pairs.withColumn("changed", F.size(F.filter("slots", lambda s: s["meant"] != s["given"])))
    best = pairs.groupBy("form", "size", "sign", "item", "tokens").agg(F.max_by(F.struct("at", "changed"), F.struct(F.size("at"), -F.col("changed"), F.col("diagonal"))).alias("b"))
    members = found.select("id", "form", "size", "sign").distinct()
    near = members.join(best, ["form", "size", "sign"])
    judged = near.groupBy("id", "item", "form", "size", "tokens").agg(F.array_distinct(F.flatten(F.collect_set("b.at"))).alias("at"), F.sum("b.changed").alias("changed"))
    judged = judged.withColumn("covered", _covered(F.col("at"), F.col("size"))).filter(F.col("covered") >= least * F.col("tokens"))
    top = judged.groupBy("id", "item").agg(F.max_by(F.struct("covered", "tokens", "changed"), F.struct(F.col("covered"), -F.col("changed"))).alias("b"))
    return top.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "b.covered", F.col("b.tokens").cast("bigint").alias("item_tokens"), F.col("b.changed").cast("bigint").alias("changed"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item. A row is told by id and text."""
    tagged = docs.withColumn("__own", F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("own")))
    leaks = find_leaks(tagged.select("__own", F.col(text_col).alias("text")), benchmark, "__own", "text", **options)
    gone = cut_lineage(leaks.select(F.col("__own.id").alias("__gone_id"), F.col("__own.own").alias("__gone_own")).distinct())
    side = F.broadcast(gone) if fits_broadcast(gone) else gone
    same = tagged[id_col].eqNullSafe(side["__gone_id"]) & (tagged["__own"]["own"] == side["__gone_own"])
    return tagged.join(side, same, "left_anti").select(*docs.columns)
