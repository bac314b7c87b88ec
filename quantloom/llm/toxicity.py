"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses, a clause's words become symbols (insult, threat, target, negation, speech
verb, verb of belief, quotation mark, comma), and a cascade of transducers rewrites the symbols: targets on either side mark
what is aimed at someone, negation marks what it negates, and reported speech what is only quoted, be it
after the verb of speech or before it ("..., he said"). The
machine runs over each clause that holds an insult or a threat and adds up the weights of the rewritten
symbols; a document's score is a rising function of its clauses' scores and of nothing else. What counts
as an insult is learned from labelled documents as words and word beginnings; how much less a negated or
reported one weighs, and how much more a targeted one, starts from stated values and follows the labels,
but never against that order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fit_logistic, id_bucket, saved
from .wordcodes import NOT_LETTER, Words, mix, text_blocks, words_of

SAMPLE_ROWS = 20_000  # labelled rows to learn from at most, the first by hash of their ids; the lexicon's size follows from them
HEADS = (4, 5, 6)  # bytes of the word beginnings that are learned besides whole words

THREATS = "kill hurt destroy beat punish burn crush shoot stab töten zerstören schlagen tuer détruire frapper matar destruir golpear".split()
TARGETS = "you your yours yourself him his her them their dich dir dein euch toi te vous votre tes ton usted ustedes ti".split()
SUBJECTS = "he she they du ihr sie tu tú tus vosotros".split()
NEGATIONS = "not no never neither nor without nobody none hardly cannot niemand nadie nicht kein keine nie ohne ne pas jamais sans nunca sin jamás ni".split()
SPEECH = "said says say told called claims claimed wrote reported quoted sagte sagt meinte schrieb dit disait écrit affirme dijo dice escribió afirma".split()

BELIEFS = "think thinks thought believe believes believed consider considers find finds glaube glaubt denke denkt finde findet crois croit pense pensent creo cree piensa pienso".split()
AIM = {"insult": 8, "threat": 4}  # words on from a target that it still aims at
AIM_BACK = {"insult": 8, "threat": 2}  # the same for a target behind: "kill all you", but not "kill time for you"
REACH, REACH_ON = 3, 6  # words that a negation reaches, and that it reaches from a verb of belief or speech on
TAIL = 2  # words between an attribution's verb and the clause's end, and between its comma and the verb


class Transducer(NamedTuple):
    """``arcs[state, symbol] = (next state, output symbol)``; without an arc, state and symbol stay."""

    start: object
    arcs: dict

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol))


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that feeds the output of ``first`` to ``second``; states that can be reached only."""
    symbols = {s for t in (first, second) for _, s in t.arcs} | {o for t in (first, second) for _, o in t.arcs.values()} | set(SYMBOLS)
    start = (first.start, second.start)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            a, middle = first.step(state[0], symbol)
            b, out = second.step(state[1], middle)
            if ((a, b), out) != (state, symbol):
                arcs[state, symbol] = ((a, b), out)
            if (a, b) not in seen:
                seen.add((a, b))
                todo.append((a, b))
    return Transducer(start, arcs)


INSULT, THREAT, TARGET, SUBJECT, NEGATION, VERB, BELIEF, QUOTE, COMMA, OTHER = SYMBOLS = ("insult", "threat", "target", "subject", "negation", "verb", "belief", "quote", "comma", "other")
_SIGNS = (QUOTE, COMMA)  # no words, so they count for no distance
# weights of an insult and a threat as they stand, and what a mark multiplies them by: targeted, negated, reported
WEIGHTS = {INSULT: 1.0, THREAT: 0.5}
MARKS = {(INSULT, "+t"): 1.5, (THREAT, "+t"): 4.0, (INSULT, "-n"): 0.25, (THREAT, "-n"): 0.1, (INSULT, "/r"): 0.4, (THREAT, "/r"): 0.4}
PRIOR_ROWS = 20  # the stated values count as so many documents


def _target(aim: dict) -> Transducer:
    """A target marks the insults and threats that follow it within ``aim`` words, one that can only be a subject no threats."""
    none, farthest = ("none", 0), max(aim.values())
    arcs: dict = {}
    for state in [none, *((kind, far) for kind in (TARGET, SUBJECT) for far in range(farthest))]:
        kind, far = state
        if state != none:
            on = (kind, far + 1) if far + 1 < farthest else none
            arcs |= {(state, s): (on, s) for s in SYMBOLS if s not in _SIGNS}
            for s in (INSULT, THREAT):
                if far < aim[s] and (s, kind) != (THREAT, SUBJECT):
                    arcs[state, s] = (on, f"{s}+t")
                arcs[state, f"{s}+t"] = (on, f"{s}+t")
        arcs[state, TARGET] = ((TARGET, 0), TARGET)
        if kind != TARGET or far >= AIM[THREAT]:  # a subject doesn't take the place of a target that still aims
            arcs[state, SUBJECT] = ((SUBJECT, 0), SUBJECT)
    return Transducer(none, arcs)


def _grammar() -> Transducer:
    """target o negation o reported speech, from left to right."""
    negation: dict = {}
    for left in range(REACH_ON + 1):  # words that a negation still reaches
        negation[left, NEGATION] = (REACH, NEGATION)
        if left:
            negation |= {(left, s): (left - 1, s) for s in SYMBOLS if s != NEGATION and s not in _SIGNS}
            negation |= {(left, s): (REACH_ON, s) for s in (BELIEF, VERB)}
            negation |= {(left, t): (left - 1, f"{t}-n") for s in (INSULT, THREAT) for t in (s, f"{s}+t")}
    report: dict = {}
    for s in (INSULT, THREAT):
        for t in (s, f"{s}+t", f"{s}-n", f"{s}+t-n"):
            for state in ("said", "quoted"):
                report[state, t] = (state, f"{t}/r")
    report[("plain", VERB)] = ("said", VERB)
    report[("plain", QUOTE)] = report[("said", QUOTE)] = ("quoted", QUOTE)
    report[("quoted", QUOTE)] = ("plain", QUOTE)
    return compose(compose(_target(AIM), Transducer(0, negation)), Transducer("plain", report))


def _attribution() -> Transducer:
    """From right to left: a comma, at most ``TAIL`` words, a verb of speech and at most ``TAIL`` words at the
    clause's end tell that what stands before the comma is only reported."""
    marked = [f"{s}{t}{n}" for s in (INSULT, THREAT) for t in ("", "+t") for n in ("", "-n")]
    words = [s for s in SYMBOLS if s not in _SIGNS] + [f"{t}{r}" for t in marked for r in ("", "/r")]
    arcs: dict = {}
    for seen in range(TAIL + 1):
        for step in ("end", "verb"):
            arcs |= {((step, seen), s): ((step, seen + 1) if seen < TAIL else "plain", s) for s in words}
        arcs[("end", seen), VERB] = (("verb", 0), VERB)
        arcs[("end", seen), COMMA] = ("plain", COMMA)
        arcs[("verb", seen), COMMA] = ("reported", COMMA)
    return Transducer(("end", 0), arcs | {("reported", t): ("reported", f"{t}/r") for t in marked})


GRAMMAR, BACKWARD, ATTRIBUTION = _grammar(), _target(AIM_BACK), _attribution()


def _rewritten(machine: Transducer, symbols: list[str]) -> list[str]:
    state, out = machine.start, []
    for symbol in symbols:
        state, symbol = machine.step(state, symbol)
        out.append(symbol)
    return out


def clause_outputs(symbols: list[str]) -> list[str]:
    """What the grammar makes of a clause: first the targets that follow, from right to left, then the composed machine,
    then, from right to left again, an attribution behind."""
    made = _rewritten(GRAMMAR, _rewritten(BACKWARD, symbols[::-1])[::-1])
    return _rewritten(ATTRIBUTION, made[::-1])[::-1]


def symbol_weight(symbol: str, weights: dict, marks: dict) -> float:
    kind = next((k for k in (INSULT, THREAT) if symbol.startswith(k)), None)
    if kind is None:
        return 0.0
    weight = weights[kind]
    for mark in ("+t", "-n", "/r"):
        weight *= marks[kind, mark] if mark in symbol else 1.0
    return weight


def learned_marks(seen: dict[str, tuple[int, int]]) -> dict:
    """Values of ``MARKS`` after labelled documents: ``seen`` has, for a symbol, how many toxic and how many
    clean documents have it as their strongest one. They move with the share of toxic ones, compared with
    that of the plain symbol; a target never lowers a weight, negation and report never raise one."""
    out = {}
    for (kind, mark), stated in MARKS.items():
        toxic, clean = seen.get(kind + mark, (0, 0))
        plain_toxic, plain_clean = seen.get(kind, (0, 0))
        n = toxic + clean
        share = ((toxic + 0.5) / (n + 1)) / ((plain_toxic + 0.5) / (plain_toxic + plain_clean + 1))
        value = (PRIOR_ROWS * stated + n * share) / (PRIOR_ROWS + n)
        out[kind, mark] = max(1.0, value) if mark == "+t" else min(1.0, value)
    return out


_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".!?;\n"]] = True
_MARKS = [bytes([0xE2, 0x80, x]) for x in (0x9C, 0x9D, 0x9E, 0x9F)] + [bytes([0xC2, x]) for x in (0xAB, 0xBB)]  # quotation marks besides "


def plain_bytes(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with all double quotation marks as ``"`` and the Latin-1 capitals lowered; as many bytes as before.
    A single one may be an apostrophe and is none; the curved one becomes three plain ones."""
    high = np.flatnonzero((data == 0xC3) | (data == 0xC2) | (data == 0xE2))
    if not len(high):
        return data
    data = np.concatenate((data, np.zeros(2, np.uint8)))
    after, third = data[high + 1], data[high + 2]
    capital = high[(data[high] == 0xC3) & (after >= 0x80) & (after <= 0x9E) & (after != 0x97)]
    data[capital + 1] += 0x20
    for mark in _MARKS:
        at = high[(data[high] == mark[0]) & (after == mark[1]) & ((len(mark) == 2) | (third == mark[-1]))]
        data[at] = ord('"')
        for i in range(1, len(mark)):
            data[at + i] = ord(" ")
    curved = high[(data[high] == 0xE2) & (after == 0x80) & (third == 0x99)]
    for i in range(3):
        data[curved + i] = ord("'")
    return data[:-2]


def _codes(words: list[str]) -> np.ndarray:
    data = plain_bytes(np.frombuffer(" ".join(words).encode(), np.uint8))
    return np.unique(words_of(data, np.array([0, len(data)]), NOT_LETTER).codes)


class _Lookup:
    """Membership in a bounded set of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.unique(codes)
        self.near = np.zeros(1 << 16, bool)
        self.near[(self.codes >> np.uint64(48)).astype(np.int64)] = True

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        out = self.near[(codes >> np.uint64(48)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(self.codes):
            place = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
            out[at] = self.codes[place] == codes[at]
        return out


def _units(words: Words) -> list[np.ndarray]:
    """Codes of each word and of its beginnings (0 if the word is no longer than that); their kinds are told apart by salts."""
    size = words.ends - words.starts
    out = [words.codes]
    for k in HEADS:
        out.append(np.where(size > k, words.heads(k) * np.uint64(2 * k + 1), np.uint64(0)))
    return out


def _contracted(data: np.ndarray, words: Words) -> np.ndarray:
    """Which words end in n and go on with an apostrophe and a t alone, in the same row."""
    out = np.zeros(len(words.codes), bool)
    if len(out) < 2:
        return out
    end, after, row = words.ends[:-1], words.starts[1:], words.rows()
    gap = after - end
    sign = ((gap == 1) | (gap == 3)) & (data[end] == ord("'")) & (data[after - 1] == ord("'"))
    lone_t = (words.ends[1:] - after == 1) & ((data[after] | 0x20) == ord("t"))
    out[:-1] = sign & lone_t & ((data[end - 1] | 0x20) == ord("n")) & (row[1:] == row[:-1])
    return out


_NONE = np.uint64(0)
FEATURES = 3


class ClauseScorer:
    """Clauses of texts as the grammar scores them."""

    def __init__(self, insults: np.ndarray, marks: dict = MARKS):
        self.insults, self.marks = _Lookup(np.array(insults, np.uint64)), marks
        self.fixed = [(kind, _Lookup(_codes(words))) for kind, words in ((THREAT, THREATS), (TARGET, TARGETS), (SUBJECT, SUBJECTS), (NEGATION, NEGATIONS), (VERB, SPEECH), (BELIEF, BELIEFS))]

    def clauses(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, list[str]]]:
        """(row, rewritten symbols) of each clause with an insult or a threat. A quotation goes on over clauses to the end of its line."""
        data = plain_bytes(data)
        words = words_of(data, bounds, NOT_LETTER)
        hit = np.zeros(len(words.codes), bool)
        for codes in _units(words):
            hit |= self.insults(codes) & (codes != _NONE)
        kinds = {kind: look(words.codes) for kind, look in self.fixed}
        core = np.flatnonzero(hit | kinds[THREAT])
        if not len(core):
            return
        shut = _contracted(data, words)  # n't: the word before is a negation, its t no word
        kinds[NEGATION] = kinds[NEGATION] | shut
        commas = np.concatenate(([0], np.cumsum(data == ord(","))))
        clause = np.cumsum(_BREAK[data])[words.starts]
        quotes = np.concatenate(([0], np.cumsum(data == ord('"'))))
        lines = np.unique(np.concatenate((bounds, np.flatnonzero(data == ord("\n")) + 1)))  # where lines begin
        row_of = words.rows()
        # a clause is a run of words with one break count in one row
        key = clause.astype(np.int64) * (len(bounds) + 1) + row_of
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        for c in np.unique(np.searchsorted(edges, core, "right") - 1):
            a, b = edges[c], edges[c + 1]
            line = lines[np.searchsorted(lines, words.starts[a], "right") - 1]
            symbols = [QUOTE] if (quotes[words.starts[a]] - quotes[line]) % 2 else []
            for w in range(a, b):
                if w > a and (quotes[words.starts[w]] - quotes[words.ends[w - 1]]) % 2:
                    symbols.append(QUOTE)
                if w > a and commas[words.starts[w]] > commas[words.ends[w - 1]]:
                    symbols.append(COMMA)
                if w > a and shut[w - 1]:
                    continue
                symbols.append(INSULT if hit[w] else next((k for k, is_in in kinds.items() if is_in[w]), OTHER))
            yield int(row_of[a]), clause_outputs(symbols)

    def features(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each row: log of one more than the sum of its clauses' scores, the highest of them, and 1."""
        out = np.zeros((len(bounds) - 1, FEATURES))
        out[:, -1] = 1
        for row, made in self.clauses(data, bounds):
            score = sum(symbol_weight(s, WEIGHTS, self.marks) for s in made)
            out[row, 0] += score
            out[row, 1] = max(out[row, 1], score)
        out[:, 0] = np.log1p(out[:, 0])
        return out

    def strongest(self, data: np.ndarray, bounds: np.ndarray) -> list[str | None]:
        """The symbol with the highest weight of each row."""
        best: list[tuple[float, str] | None] = [None] * (len(bounds) - 1)
        for row, made in self.clauses(data, bounds):
            top = max((symbol_weight(s, WEIGHTS, self.marks), s) for s in made)
            best[row] = max(best[row] or top, top)
        return [x and x[1] for x in best]


def rising_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression without negative weights: columns that get one are left out."""
    keep = list(range(x.shape[1] - 1))
    while True:
        w = np.zeros(x.shape[1])
        w[[*keep, x.shape[1] - 1]] = fit_logistic(x[:, [*keep, x.shape[1] - 1]], y)
        if not keep or (w[keep] >= 0).all():
            return w
        keep = [k for k in keep if w[k] >= 0]


def _count_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(code, toxic, clean): in how many documents of either label a unit stands."""
    held = [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
    fresh: list[tuple[np.ndarray, int]] = []

    def merged():
        codes = np.concatenate([held[0], *(c for c, _ in fresh)])
        toxic = np.concatenate([held[1], *(np.full(len(c), y) for c, y in fresh)])
        clean = np.concatenate([held[2], *(np.full(len(c), 1 - y) for c, y in fresh)])
        codes, at = np.unique(codes, return_inverse=True)
        return [codes, np.bincount(at, toxic, len(codes)).astype(np.int64), np.bincount(at, clean, len(codes)).astype(np.int64)]

    waiting = 0
    for batch in batches:
        labels = batch.column("toxic").to_numpy(zero_copy_only=False)
        for row, data, bounds in text_blocks(batch.column("text")):
            words = words_of(plain_bytes(data), bounds, NOT_LETTER)
            units = _units(words)
            for i in range(len(bounds) - 1):
                own = slice(words.offsets[i], words.offsets[i + 1])
                codes = np.unique(np.concatenate([u[own] for u in units]))
                fresh.append((codes[codes != _NONE], int(labels[row + i])))
                waiting += len(codes)
        if waiting > 1 << 19:
            held, fresh, waiting = merged(), [], 0
    held = merged()
    if len(held[0]):
        yield pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1]), pa.array(held[2])], ["code", "toxic", "clean"])


def _contexts(lookup: _Lookup):
    """(code, context): for each occurrence of a unit, the words of its text on both sides; a text's ends count as a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, bounds in text_blocks(batch.column("text")):
                words = words_of(plain_bytes(data), bounds, NOT_LETTER)
                before, after = np.roll(words.codes, 1), np.roll(words.codes, -1)
                first, stop = np.asarray(words.offsets[:-1]), np.asarray(words.offsets[1:])
                before[first[first < stop]] = after[stop[first < stop] - 1] = _NONE
                context = mix(before + np.uint64(3) * after)
                for codes in _units(words):
                    at = np.flatnonzero(lookup(codes) & (codes != _NONE))
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(codes[at].view(np.int64)), pa.array(context[at].view(np.int64))], ["code", "context"])

    return run


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[ClauseScorer, np.ndarray]:
    """The scorer and its regression weights, from labelled documents outside the held-out part."""
    known = labels.where((id_bucket() % 5 != 0) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("long").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    train = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(known), "doc_id"), "labelled")
    sizes = train.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    n_toxic, n_clean = int(sizes["toxic"] or 0), int(sizes["n"]) - int(sizes["toxic"] or 0)
    counts = train.select("text", "toxic").mapInArrow(_count_units, "code long, toxic long, clean long").groupBy("code").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # a unit must stand out of what chance makes of so many units, and in as many different contexts, so that copies of one text don't count
    least = max(3, round(1.5 + math.log10(max(1, n_toxic + n_clean))))
    rate = f"((toxic / {max(1, n_toxic)}D) / ((clean + 0.5D) / {max(1, n_clean) + 1}D))"
    held = counts.where(f"toxic >= {least} and toxic >= 8 * clean and {rate} >= 8").select("code").collect()
    lookup = _Lookup(np.array([r["code"] for r in held], np.int64).view(np.uint64))
    around = train.where("toxic = 1").select("text").mapInArrow(_contexts(lookup), "code long, context long").distinct()
    picked = around.groupBy("code").count().where(f"count >= {least}").select("code").collect()
    insults = np.array([r["code"] for r in picked], np.int64).view(np.uint64)
    found = train.select("text", "toxic").mapInArrow(_strongest(ClauseScorer(insults)), "symbol string, toxic long").groupBy("symbol").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
    seen = {r["symbol"]: (int(r["toxic"]), int(r["n"] - r["toxic"])) for r in found.where("symbol is not null").collect()}
    scorer = ClauseScorer(insults, learned_marks(seen))
    got = train.select("text", "toxic").mapInArrow(_features(scorer), "x array<double>, toxic long").toPandas()
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, FEATURES))
    return scorer, rising_logistic(x, got["toxic"].to_numpy(np.float64))


def _strongest(scorer: ClauseScorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = [s for _, data, bounds in text_blocks(batch.column("text")) for s in scorer.strongest(data, bounds)]
            yield pa.RecordBatch.from_arrays([pa.array(symbols, pa.string()), batch.column("toxic")], ["symbol", "toxic"])

    return run


def _features(scorer: ClauseScorer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [scorer.features(data, bounds) for _, data, bounds in text_blocks(batch.column("text"))]
            if parts:
                x = np.concatenate(parts)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * FEATURES), pa.array(x.reshape(-1))), batch.column("toxic")], ["x", "toxic"])

    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """For each row of ``docs(doc_id, text)``: doc_id, held_out, score in 0..1, predicted.

    Learns from at most ``sample_rows`` rows of ``labels(doc_id, toxic)`` whose crc32(doc_id as text)
    mod 5 is not 0. A text without words, null included, has the score of a text without any scored
    clause. Without labelled rows every score is 0.5. Conflicting labels of one doc_id count as toxic;
    null labels are left out. Repeated rows are scored alike; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, sample_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, weights = shared.value
        for batch in batches:
            parts = [scorer.features(data, bounds) @ weights for _, data, bounds in text_blocks(batch.column("text"))]
            score = 1 / (1 + np.exp(-np.concatenate(parts))) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_bucket() % 5 == 0).alias("held_out"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
