"""Toxicity by a weighted finite-state grammar of clauses.

A text's words become symbols: an insult (a learned stem or word, the longest that fits), a threat,
a target, a negation, a word of reported speech, or another word. Four transducers read the symbols
of a clause and are composed into one machine: ``negation`` marks insults and threats in a negation's reach,
``reported`` marks what follows a verb of speech, ``target`` marks insults with a target in reach
before or after them, and ``threat`` pairs threats with a target. What the machine writes are matches
of a kind, e.g. a negated directed insult, each with the weight of its word; a word
by itself scores nothing but through the clause it is matched in. Marks of punctuation and line ends close a clause.

Learned from labelled rows: the insults, by how much likelier a stem makes a toxic text
(stems that cover toxic texts not covered yet, and any that is frequent and plain), and
one weight for each kind of match, by logistic regression around ``PRIOR``, which says what the grammar
means where rows tell nothing. At most ``LABELLED`` rows of each label (those with the
smallest hash) are learned from, copies and near copies counting once; they stay distributed, and the driver gets
at most ``CANDIDATES`` stems, which of them each toxic row holds, and one short row of features for each row.

Null texts count as empty. Texts are cut at clause ends into pieces of about ``PIECE`` bytes, so one
of any length takes bounded memory; a longer clause is cut between words (a longer word anywhere).
Without rows of both labels there are no insults and the weights are ``PRIOR``. Repeated rows get equal rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covlens.llm.common import Scratch, bounded_sample, chunks, doc_remainder, hash_words, joined, replace_columns, spare, table, utf8

LABELLED = 4096
CANDIDATES = 20_000
PIECE = 1 << 20
#: Words within which a negation or target reaches.
REACH = 4
#: Lengths in bytes of learned stems.
STEMS = range(3, 10)
#: Texts that a stem must be found in, and least log-odds of its being toxic.
SUPPORT, ODDS = 3, 1.5
#: A frequent stem is learned even if what it covers is covered: share of toxic texts, log-odds.
FREQUENT, PLAIN = 0.01, 3.0

#: Function words of the clause grammar in four languages.
NEGATIONS = "not no never none neither nor without nicht kein keine keinen nie niemals ohne ne pas jamais aucun sans nunca jamás ningún ninguna sin ni".split()
REPORTS = "said says say called calls wrote writes claimed quoted sagte sagt nannte schrieb behauptete dit disait appelé écrit dijo dice llamó escribió".split()
TARGETS = "you your yours he she they them him her du dich dir dein ihr euch sie er tu te toi vous ton votre il elle ils tú ti usted ustedes él ella ellos tus".split()
THREATS = "kill kills killing hurt destroy beat shoot stab burn töten umbringen schlagen vernichten erschießen tuer frapper détruire brûler matar golpear destruir quemar".split()

#: Meaning of each kind of match before rows are seen: insults (I) and threats (X), negated (-), reported (r), directed (d); + is a target behind an insult.
PRIOR = {"I": 1.0, "Id": 1.5, "I-": 0.3, "I-d": 0.4, "Ir": 0.5, "Ird": 0.7, "I-r": 0.2, "I-rd": 0.2, "+": 0.5, "X": 2.0, "X-": 0.3, "Xr": 0.6, "X-r": 0.2}
KINDS = list(PRIOR)
#: Then the matches' weight for each hundred words, the share of matched clauses, and a constant.
MEANS = np.array([*PRIOR.values(), 0.5, 0.5, -4.0])
SPREAD = 2.0

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256), ord("'")]] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?;:,\n"]] = True
_WORDS = re.compile(rb"[0-9a-z'\x80-\xff]+")

Step = Callable[[tuple, str], tuple[tuple, str]]


def compose(first: tuple[tuple, Step], second: tuple[tuple, Step]) -> tuple[tuple, Step]:
    """The transducer that gives what ``first`` writes to ``second``."""

    def step(state: tuple, symbol: str) -> tuple[tuple, str]:
        a, between = first[1](state[0], symbol)
        b, out = second[1](state[1], between)
        return (a, b), out

    return (first[0], second[0]), step


def _later(n: int) -> int:
    return min(n + 1, REACH)


def _negation(state: tuple, symbol: str) -> tuple[tuple, str]:
    (since,) = state
    if symbol == "N":
        return (0,), symbol
    return (_later(since),), symbol + "-" if symbol in "IT" and since < REACH else symbol


def _reported(state: tuple, symbol: str) -> tuple[tuple, str]:
    (said,) = state
    if symbol == "R":
        return (1,), symbol
    return state, symbol + "r" if symbol[0] in "IT" and said else symbol


def _target(state: tuple, symbol: str) -> tuple[tuple, str]:
    target, insult = state
    if symbol == "G":
        return (0, REACH), "G+" if insult < REACH else "G"
    if symbol[0] == "I":
        return (_later(target), REACH if target < REACH else 0), symbol + "d" if target < REACH else symbol
    return (_later(target), _later(insult)), symbol


def _threat(state: tuple, symbol: str) -> tuple[tuple, str]:
    """Threats (T) become matches (X) where a target follows, and a match follows that one's mark of an insult (G+)."""
    kind, since = state
    if symbol[0] == "T":
        return (symbol[1:], 0), ""
    if symbol[0] == "G":
        mark = symbol[1:]
        return ("", REACH), f"X{kind}{',' + mark if mark else ''}" if since < REACH else mark
    return (kind if since < REACH else "", _later(since)), symbol if symbol[0] == "I" else ""


#: Symbols that the machine reads.
ALPHABET = "wNRGTI"


def machine() -> tuple[list[list[int]], list[list[tuple[int, ...]]]]:
    """next[state][symbol] and the kinds written, of the composed transducers from the start of a clause."""
    start, step = compose(compose(compose(((REACH,), _negation), ((0,), _reported)), ((REACH, REACH), _target)), (("", REACH), _threat))
    number, todo, following, written = {start: 0}, [start], [], []
    for state in todo:
        nexts, outs = [], []
        for symbol in ALPHABET:
            after, out = step(state, symbol)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            nexts.append(number[after])
            outs.append(tuple(KINDS.index(k) for k in out.split(",") if k))
        following.append(nexts)
        written.append(outs)
    return following, written


def hashes(words: list[bytes]) -> np.ndarray:
    """Hash of each word as ``hash_words`` has it."""
    if not words:
        return np.empty(0, np.uint64)
    data, begin = joined(words)
    separator = np.ones(len(data), bool)
    separator[begin[1:] - 1] = False
    separator[-1] = False
    return hash_words(data, separator)[1]


class Lexicon:
    """Symbols of words: learned stems (with the weight of the longest one that fits) and the fixed words."""

    def __init__(self, stems: dict[bytes, float]):
        """``stems`` maps a stem, or a whole word with ``$`` behind it, to its weight; weight 0 makes an exception."""
        self.by_length = {}
        for n in sorted({len(s) for s in stems if not s.endswith(b"$")}):
            self.by_length[n] = self._sorted({s: w for s, w in stems.items() if len(s) == n and not s.endswith(b"$")})
        self.whole = self._sorted({s[:-1]: w for s, w in stems.items() if s.endswith(b"$")})
        fixed = {w.encode(): ALPHABET.index(k) for k, words in (("N", NEGATIONS), ("R", REPORTS), ("G", TARGETS), ("T", THREATS)) for w in words}
        self.fixed = self._sorted(fixed)

    @staticmethod
    def _sorted(weights: dict[bytes, float]) -> tuple[np.ndarray, np.ndarray]:
        keys = hashes(list(weights))
        order = np.argsort(keys)
        return keys[order], np.array(list(weights.values()), np.float64)[order]

    @staticmethod
    def _found(held: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of ``keys`` that are held, and their values."""
        if not len(held[0]) or not len(keys):
            return np.empty(0, np.int64), np.empty(0)
        at = np.minimum(np.searchsorted(held[0], keys), len(held[0]) - 1)
        hit = np.flatnonzero(held[0][at] == keys)
        return hit, held[1][at[hit]]

    def symbols(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start of each word, its symbol (0: another word) and an insult's weight."""
        is_word = _WORD[data]
        starts, whole = hash_words(data, is_word)
        last = is_word.copy()
        last[:-1] &= ~is_word[1:]
        length = np.flatnonzero(last) + 1 - starts
        symbol, weight = np.zeros(len(starts), np.int8), np.zeros(len(starts))
        hit, kind = self._found(self.fixed, whole)
        symbol[hit] = kind
        insult = ALPHABET.index("I")
        for n, held in self.by_length.items():
            long = np.flatnonzero(length >= n)
            if len(long):
                hit, w = self._found(held, prefix_hashes(data, starts[long], n))
                symbol[long[hit]], weight[long[hit]] = np.where(w > 0, insult, 0), w
        hit, w = self._found(self.whole, whole)
        symbol[hit], weight[hit] = np.where(w > 0, insult, 0), w
        return starts, symbol, weight


def prefix_hashes(data: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` bytes from each start, as of a word."""
    held = np.empty((len(starts), n + 1), np.uint8)
    for k in range(n):
        held[:, k] = data[starts + k]
    held[:, n] = 0
    is_byte = np.ones(held.shape, bool)
    is_byte[:, n] = False
    return hash_words(held.ravel(), is_byte.ravel())[1]


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(text, first byte, piece): texts in lower case (A-Z), long ones cut behind the last clause end, else white space, of each PIECE bytes."""
    for i, t in enumerate(texts):
        t, at = t.lower(), 0
        while len(t) > PIECE:
            head = np.frombuffer(t, np.uint8, PIECE)
            for marks in (_END, ~_WORD):
                cut = np.flatnonzero(marks[head[PIECE // 2 :]])
                if len(cut):
                    break
            n = PIECE // 2 + int(cut[-1]) + 1 if len(cut) else PIECE
            yield i, at, t[:n]
            t, at = t[n:], at + n
        yield i, at, t


class Grammar:
    """The composed machine over a lexicon."""

    def __init__(self, stems: dict[bytes, float]):
        self.lexicon, (self.next, self.written) = Lexicon(stems), machine()

    def features(self, texts: list[bytes], matches: list[list[tuple]] | None = None) -> np.ndarray:
        """A row of features for each text; ``matches`` gets each text's clauses as (first byte, last byte + 1, kinds, weight)."""
        total = np.zeros((len(texts), len(KINDS)))
        words, clauses, matched = (np.zeros(len(texts)) for _ in range(3))
        units = list(pieces(texts))
        for a, b in chunks([p for _, _, p in units]):
            owner = np.array([i for i, _, _ in units[a:b]])
            data, begin = joined([p for _, _, p in units[a:b]])
            starts, symbol, weight = self.lexicon.symbols(data)
            of = np.searchsorted(begin, starts, side="right") - 1
            clause = np.cumsum(_END[data])[starts] if len(starts) else np.empty(0, np.int64)
            np.add.at(words, owner[of], 1)
            first = np.flatnonzero(np.diff(clause, prepend=-1))
            np.add.at(clauses, owner[of[first]], 1)
            seeds = np.unique(clause[(symbol == ALPHABET.index("I")) | (symbol == ALPHABET.index("T"))])
            special = np.flatnonzero(symbol > 0)
            special = special[np.isin(clause[special], seeds, assume_unique=False)] if len(special) else special
            groups = np.split(special, np.flatnonzero(np.diff(clause[special])) + 1) if len(special) else []
            for group in groups:
                kinds, sum_ = self.clause(group, symbol, weight, total[owner[of[group[0]]]])
                if kinds:
                    unit = int(of[group[0]])
                    i = int(owner[unit])
                    matched[i] += 1
                    if matches is not None:
                        k = clause[group[0]]
                        lo, hi = np.searchsorted(clause, k), np.searchsorted(clause, k, side="right") - 1
                        end = int(starts[hi]) + int(np.argmin(np.append(_WORD[data[starts[hi] :]], False)))
                        at = units[a + unit][1] - int(begin[unit])
                        matches[i].append((int(starts[lo]) + at, end + at, kinds, sum_))
        rate = np.log1p(100 * total.sum(1) / np.maximum(words, 20))
        return np.column_stack([np.log1p(total), rate, matched / np.maximum(clauses, 1), np.ones(len(texts))])

    def clause(self, group: np.ndarray, symbol: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[list[str], float]:
        """Runs the machine over a clause's symbols (words between them only count); adds to ``total`` by kind."""
        state, kinds, held, before = 0, [], 0.0, group[0] - REACH - 1
        insult = 0.0
        for k in group.tolist():
            for _ in range(min(k - before - 1, REACH)):
                state = self.next[state][0]
            s = int(symbol[k])
            if s == ALPHABET.index("I"):
                insult = float(weight[k])
            for kind in self.written[state][s]:
                w = insult if KINDS[kind][0] == "I" else 1.0
                total[kind] += w
                held += w
                kinds.append(KINDS[kind])
            state, before = self.next[state][s], k
        return kinds, held


def fit_weights(x: np.ndarray, y: np.ndarray, importance: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic regression with normal priors around MEANS, by Newton's method with halved steps."""
    w = MEANS.copy()

    def loss(v):
        z = x @ v
        return (importance * (np.logaddexp(0, z) - y * z)).sum() + ((v - MEANS) ** 2).sum() / (2 * SPREAD**2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        g = x.T @ (importance * (p - y)) + (w - MEANS) / SPREAD**2
        h = (x * (importance * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / SPREAD**2
        move, size = np.linalg.solve(h, g), 1.0
        while size > 1e-4 and loss(w - size * move) > loss(w):
            size /= 2
        w = w - size * move
        if np.abs(size * move).max() < 1e-8:
            break
    return w


def stems_of(text: bytes) -> set[bytes]:
    """Stems and whole words (with ``$``) of a text in lower case."""
    out = set()
    for w in set(_WORDS.findall(text)):
        out.update(w[:n] for n in STEMS if len(w) >= n)
        out.add(w[:64] + b"$")
    return out


def _copy_key(text: bytes) -> int:
    """Equal for copies, mostly for near copies: the least hash of five words in a row."""
    words = _WORDS.findall(text)
    return min((zlib.crc32(b" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))), default=0)


def learn_stems(rows: DataFrame) -> dict[bytes, float]:
    """Insults of the labelled ``rows`` (t, y), distinct texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, list[int]] = defaultdict(lambda: [0, 0])
        for b in batches:
            for t, y in zip(utf8(b["t"]), b["y"], strict=True):
                for s in stems_of(t.lower()):
                    seen[s][y] += 1
                if len(seen) > 500_000:
                    yield as_frame(seen)
                    seen.clear()
        yield as_frame(seen)

    def as_frame(seen) -> pd.DataFrame:
        return pd.DataFrame({"stem": pd.Series(list(seen), dtype=object), "clean": [v[0] for v in seen.values()], "toxic": [v[1] for v in seen.values()]})

    sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    n_clean, n_toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not n_clean or not n_toxic:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("clean") + 0.5) / (n_clean + 1))
    counted = rows.mapInPandas(count, "stem binary, clean long, toxic long").groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    likely = counted.withColumn("odds", odds).where((F.col("toxic") >= SUPPORT) & (F.col("odds") >= ODDS))
    likely = without_beginnings(likely.orderBy(F.desc(F.col("toxic") * F.col("odds")), "stem").limit(CANDIDATES).collect())
    candidates = {bytes(r.stem): k for k, r in enumerate(likely)}
    if not candidates:
        return {}
    sent = rows.sparkSession.sparkContext.broadcast(candidates)

    @F.pandas_udf("array<int>")
    def holds(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted(sent.value[s] for s in stems_of(t.lower()) if s in sent.value) for t in utf8(texts)])

    texts = [r.c for r in rows.where("y = 1").select(holds("t").alias("c")).collect()]
    chosen = cover(texts, np.array([r.odds for r in likely]), [bytes(r.stem) for r in likely])
    frequent = [k for k, r in enumerate(likely) if r.toxic >= max(2 * SUPPORT, FREQUENT * n_toxic) and r.odds >= PLAIN]
    stems = {bytes(likely[k].stem): float(likely[k].odds) for k in {*chosen, *frequent}}
    known = rows.sparkSession.sparkContext.broadcast({s for s in stems if not s.endswith(b"$")})

    def exceptions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, list[int]] = defaultdict(lambda: [0, 0])
        for b in batches:
            for t, y in zip(utf8(b["t"]), b["y"], strict=True):
                for w in set(_WORDS.findall(t.lower())):
                    if any(w[:n] in known.value for n in STEMS):
                        seen[w[:64] + b"$"][y] += 1
        yield as_frame(seen)

    words = rows.mapInPandas(exceptions, "stem binary, clean long, toxic long").groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # a word of a learned stem that clean texts use as well is none
    plain_words = words.where("clean >= 2").withColumn("odds", odds).where(F.col("odds") < 1).orderBy(F.desc("clean"), "stem").limit(CANDIDATES)
    return stems | {bytes(r.stem): 0.0 for r in plain_words.collect()}


def without_beginnings(likely: list) -> list:
    """Leaves out stems that are little more than the beginning of one longer stem or word."""
    longest = Counter()
    for r in likely:
        stem = bytes(r.stem)
        for n in STEMS:
            if n < len(stem):
                longest[stem[:n]] = max(longest[stem[:n]], r.toxic)
    return [r for r in likely if longest[bytes(r.stem)] < 0.9 * r.toxic]


def cover(texts: list[list[int]], odds: np.ndarray, stems: list[bytes]) -> list[int]:
    """Stems, each the best for the texts that none before it is found in; ties go to the longest."""
    holders = defaultdict(list)
    for i, held in enumerate(texts):
        for k in held:
            holders[k].append(i)
    holders = {k: np.array(v) for k, v in holders.items()}
    left, chosen = np.ones(len(texts), bool), []
    gain = {k: len(v) * odds[k] for k, v in holders.items()}
    while gain:
        best = max(gain, key=lambda k: (gain[k], len(stems[k]), stems[k]))
        now = left[holders[best]].sum()
        if now * odds[best] < gain[best]:  # was of use before; gains only fall
            gain[best] = now * odds[best]
            if now < SUPPORT:
                del gain[best]
            continue
        chosen.append(best)
        left[holders[best]] = False
        del gain[best]
    return chosen


class Model:
    def __init__(self, stems: dict[bytes, float], weights: np.ndarray):
        self.stems, self.weights = stems, weights


def fit(labelled: DataFrame, text: str = "text", label: str = "label", max_labelled: int = LABELLED) -> Model:
    """Learns insults and weights from ``text`` and a 0/1 ``label``; null labels are left out."""
    scratch = Scratch(labelled.sparkSession)
    known = labelled.select(F.coalesce(F.col(text), F.lit("")).alias("t"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    if len(counts) < 2:
        return Model({}, MEANS.copy())

    @F.pandas_udf("long")
    def copy_key(texts: pd.Series) -> pd.Series:
        return pd.Series([_copy_key(t.lower()) for t in utf8(texts)], dtype="int64")

    sample = [bounded_sample(known.where(F.col("y") == y), F.col("t"), max_labelled) for y in (0, 1)]
    sample = scratch.cut(sample[0].unionByName(sample[1]).groupBy("y", copy_key("t").alias("copies")).agg(F.min("t").alias("t")))
    stems = learn_stems(sample)
    sent = labelled.sparkSession.sparkContext.broadcast(stems)

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        grammar = Grammar(sent.value)
        for b in batches:
            yield pd.Series(list(grammar.features(utf8(b))))

    rows = sample.select("y", features("t").alias("x")).collect()
    x, y = np.array([r.x for r in rows]), np.array([r.y for r in rows])
    share = counts[1] / (counts[0] + counts[1])
    importance = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    scratch.clear()
    return Model(stems, fit_weights(x, y, importance))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``clauses``, the matched clauses' places in code points, kinds of match and weight.

    Input columns of these names (whatever their case) give way.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.stems, model.weights))

    @F.pandas_udf("score double, clauses array<struct<start:int,end:int,kinds:string,weight:double>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        stems, weights = sent.value
        grammar = Grammar(stems)
        for b in batches:
            texts = utf8(b)
            matches: list[list[tuple]] = [[] for _ in texts]
            z = grammar.features(texts, matches) @ weights
            yield pd.DataFrame({"score": 1 / (1 + np.exp(-np.clip(z, -500, 500))), "clauses": [in_points(t, m) for t, m in zip(texts, matches, strict=True)]})

    both = run(F.col(f"`{text}`"))
    name = spare(docs, "_toxicity")
    return replace_columns(docs.withColumn(name, both), {"score": F.col(f"{name}.score"), "clauses": F.col(f"{name}.clauses")}).drop(name)


def in_points(text: bytes, matches: list[tuple]) -> list[dict]:
    """Matches with places in code points."""
    if not matches:
        return []
    before = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    point = lambda k: int(before[k - 1]) if k else 0
    return [{"start": point(a), "end": point(b), "kinds": ",".join(kinds), "weight": w} for a, b, kinds, w in matches]


def op13_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (doc_remainder(F.col("doc_id"), 5) == 0).alias("held_out"))
    known = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label")).where("label in (0, 1)")
    known = known.where(doc_remainder(F.col("doc_id"), 5) != 0)
    # 2 * LABELLED rows at most, so they are sent to the texts
    sampled = [bounded_sample(known.where(F.col("label") == y), F.col("doc_id"), LABELLED) for y in (0, 1)]
    model = fit(docs.join(F.broadcast(sampled[0].unionByName(sampled[1])), "doc_id"))
    out = score(docs, model)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
