"""Language identification: script ranges narrow the candidates, Viterbi over words labels spans."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arcloom.llm.text import bounded, passes, small_batches, word_bounds

#: Documents of one language that the word model learns from, about: a share of them chosen by a hash of the id.
MAX_TRAIN_DOCS = 4_000
#: Slots of hashed byte trigrams.
SLOTS = 1 << 16
#: Log-probability that a change of language between two neighbouring words costs.
SWITCH = 12.0
#: A language is a candidate for a script in which at least this share of its training letters are.
SCRIPT_SHARE = 0.002
UNKNOWN = "und"

#: First code points of script blocks, and the script that each block belongs to.
SCRIPT_STARTS = [
    0x0000, 0x0370, 0x0400, 0x0530, 0x0590, 0x0600, 0x0900, 0x0980, 0x0A00, 0x0B80, 0x0C00, 0x0E00, 0x0E80, 0x0F00,
    0x1000, 0x10A0, 0x1100, 0x1200, 0x13A0, 0x1400, 0x1680, 0x1780, 0x1800, 0x18B0, 0x1900, 0x1AB0, 0x1B00, 0x1C80,
    0x1C90, 0x1CC0, 0x1D00, 0x1DC0, 0x1E00, 0x1F00, 0x2000, 0x2C60, 0x2E80, 0x3040, 0x3100, 0x3130, 0x3190, 0x3400,
    0xA000, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0xFB50, 0xFE00, 0x10000, 0x20000,
]
SCRIPT_NAMES = [
    "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari", "bengali", "indic", "tamil", "indic",
    "thai", "lao", "tibetan", "myanmar", "georgian", "hangul", "ethiopic", "cherokee", "aboriginal", "runic", "khmer",
    "mongolian", "aboriginal", "tai", "common", "island", "cyrillic", "georgian", "island", "latin", "common", "latin",
    "greek", "common", "latin", "han", "kana", "han", "hangul", "han", "han", "common", "hangul", "common", "han",
    "latin", "arabic", "common", "common", "han",
]
SCRIPTS = sorted(set(SCRIPT_NAMES) - {"common"})
_START = np.array(SCRIPT_STARTS)
_INDEX = np.array([SCRIPTS.index(s) if s != "common" else -1 for s in SCRIPT_NAMES])

#: Bytes of words: ASCII letters and all bytes of other characters.
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


def _code_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points whose first byte, over 0x7F, is at ``at``."""
    b = [data[np.minimum(at + d, len(data) - 1)].astype(np.int64) & 63 for d in range(4)]
    lead = data[at].astype(np.int64)
    two = (lead & 31) << 6 | b[1]
    three = (lead & 15) << 12 | b[1] << 6 | b[2]
    four = (lead & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3]
    return np.where(lead < 0xE0, two, np.where(lead < 0xF0, three, four))


def word_scripts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Index into SCRIPTS of each word: of its last non-Latin letter, else Latin; -1 without letters."""
    out = np.where(np.add.reduceat((data >= 97) & (data < 123), starts) > 0, SCRIPTS.index("latin"), -1) if len(starts) else starts
    at = np.flatnonzero(data >= 0xC2)
    if len(at) and len(starts):
        script = _INDEX[np.searchsorted(_START, _code_points(data, at), "right") - 1]
        word = np.searchsorted(starts, at, "right") - 1
        latin = SCRIPTS.index("latin")
        for chosen in (script == latin, (script >= 0) & (script != latin)):
            out[word[chosen]] = script[chosen]
    return out


def _trigrams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the byte trigrams of all words with a border on either side, and each word's first trigram."""
    lens = ends - starts
    first = np.cumsum(lens) - lens
    at = np.arange(int(lens.sum())) - np.repeat(first, lens) + np.repeat(starts, lens)
    word = data * _LETTER[data]
    pad = np.concatenate([[0], word, [0]]).astype(np.uint32)
    h = pad[at] * np.uint32(0x9E3779B1) + pad[at + 1] * np.uint32(0x85EBCA77) + pad[at + 2] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16)).astype(np.int64) & (SLOTS - 1), first


class LanguageModel:
    """Log-probabilities of trigram slots by language, and which languages use which script."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray) -> None:
        self.langs = langs
        total = counts.sum(1, keepdims=True)
        pooled = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * SLOTS)
        self.logp = np.log((counts + 50 * pooled) / (total + 50)).T.astype(np.float32).copy()
        share = scripts / np.maximum(scripts.sum(1, keepdims=True), 1)
        uses = (share >= SCRIPT_SHARE).T  # script x language
        self.allowed = np.where(uses.any(1, keepdims=True), uses, True)

    def word_scores(self, data, starts, ends) -> np.ndarray:
        """Log-likelihood of each word by language; languages that don't use the word's script are out."""
        if not len(starts):
            return np.zeros((0, len(self.langs)), np.float32)
        slots, first = _trigrams(data, starts, ends)
        scores = np.add.reduceat(self.logp[slots], first, axis=0)
        script = word_scripts(data, starts, ends)
        scores[script < 0] = 0
        scores[(script >= 0)[:, None] & ~self.allowed[script]] = -1e4
        return scores


def viterbi(scores: np.ndarray, rows: np.ndarray, switch: float) -> np.ndarray:
    """Best label of every word, where each change between neighbouring words of a row costs ``switch``.

    Rows (``rows`` are their starts) advance together, one word at a time; ties go to the earlier language.
    """
    n_words, n_lang = scores.shape
    out = np.zeros(n_words, np.int16)
    lens = np.diff(rows)
    order = np.argsort(-lens, kind="stable")
    starts, lens = rows[:-1][order], lens[order]
    active = int((lens > 0).sum())
    if not active:
        return out
    steps = int(lens[0])
    counts = np.searchsorted(-lens, -np.arange(1, steps + 1), "right")  # rows that have a word at each step
    value = scores[starts[:active]].astype(np.float64)
    stays = np.zeros((n_words, n_lang), bool)
    best_before = np.zeros(n_words, np.int16)
    final = np.zeros(len(lens), np.int64)
    for t in range(1, steps + 1):
        now = counts[t] if t < steps else 0
        if now < active:
            final[now:active] = value[now:active].argmax(1)
            value, active = value[:now], now
        if not now:
            break
        at = starts[:now] + t
        best = value.argmax(1)
        other = value[np.arange(now), best] - switch
        stay = value >= other[:, None]
        stays[at], best_before[at] = stay, best
        value = np.where(stay, value, other[:, None]) + scores[at]
    state = np.zeros(len(lens), np.int64)
    for t in range(steps - 1, -1, -1):
        now = counts[t]
        first = counts[t + 1] if t + 1 < steps else 0
        state[first:now] = final[first:now]
        at, s = starts[:now] + t, state[:now]
        out[at] = s
        if t:
            state[:now] = np.where(stays[at, s], s, best_before[at])
    return out


def _sample(docs: DataFrame, id_col: str, lang_col: str, most: int) -> DataFrame:
    """Rows with a language: all, or about ``most`` of each language, chosen by a hash of the id."""
    sizes = {r[0]: r[1] for r in docs.where(F.col(lang_col).isNotNull()).groupBy(lang_col).count().collect()}
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, most / n))).otherwise(share)
    chance = F.pmod(F.xxhash64(F.col(id_col)), F.lit(1_000_000)) / 1_000_000
    return docs.where(F.col(lang_col).isNotNull() & (chance < share))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most: int = MAX_TRAIN_DOCS
) -> LanguageModel:
    """Learn from whole texts of about ``most`` rows per language; rows without a language are not used."""

    def run(batches):
        counts: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for b in small_batches(batches, "t", 4 << 20):
            langs = b.column("lang").to_pylist()
            for i, j, data, rows in passes(b.column("t")):
                starts, ends = word_bounds(data, _LETTER)
                if not len(starts):
                    continue
                slots, first = _trigrams(data, starts, ends)
                script = word_scripts(data, starts, ends)
                at = np.searchsorted(starts, rows)
                cut = np.append(first, len(slots))
                for r in range(j - i):
                    a, e = at[r], at[r + 1]
                    lang = langs[i + r]
                    if lang not in counts:
                        counts[lang], scripts[lang] = np.zeros(SLOTS, np.int64), np.zeros(len(SCRIPTS), np.int64)
                    counts[lang] += np.bincount(slots[cut[a] : cut[e]], minlength=SLOTS)
                    s = script[a:e]
                    scripts[lang] += np.bincount(s[s >= 0], minlength=len(SCRIPTS))
        if counts:
            names = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([np.concatenate([counts[x], scripts[x]]).tobytes() for x in names], pa.binary())],
                names=["lang", "counts"],
            )

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"lang": table.column("lang")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    picked = _sample(docs, id_col, lang_col, most).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("t"))
    bounded(docs)
    rows = (
        picked.repartition(8).mapInArrow(run, "lang string, counts binary")
        .groupBy("lang").applyInArrow(add, "lang string, counts binary").collect()  # one row per language
    )
    rows = sorted(rows, key=lambda r: r["lang"])
    if not rows:
        return LanguageModel([UNKNOWN], np.ones((1, SLOTS)), np.ones((1, len(SCRIPTS))))
    both = np.stack([np.frombuffer(bytes(r["counts"]), np.int64) for r in rows]).astype(np.float64)
    return LanguageModel([r["lang"] for r in rows], both[:, :SLOTS], both[:, SLOTS:])


def _has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def label(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH,
    spans: bool = False,
) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text, and ``spans`` if asked for.

    Each word is labelled by Viterbi; ``lang_pred`` is the language whose words have the most bytes (ties: the
    first by name) and ``score`` its share of them. Texts that are null or have no letter get ``und`` and 0. A
    span is (lang, first word, end word); words are runs of letters. Ids may repeat or be null: rows count alone.
    """
    shared = bounded(docs).sparkSession.sparkContext.broadcast(model)
    kind = "doc_id long, lang_pred string, score double"
    kind += ", spans array<struct<lang:string,first:int,end:int>>" * spans

    def run(batches):
        own = shared.value
        names = np.array([*own.langs, UNKNOWN], object)
        for b in small_batches(batches, text_col, 4 << 20):
            pred, score, found = _predict(own, b.column(text_col), switch, spans)
            cols = [b.column(id_col).cast(pa.int64()), pa.array(names[pred], pa.string()), pa.array(score)]
            heads = ["doc_id", "lang_pred", "score"]
            if spans:
                cols.append(pa.array(found, pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("end", pa.int32())]))))
                heads.append("spans")
            yield pa.RecordBatch.from_arrays(cols, names=heads)

    return docs.select(id_col, text_col).mapInArrow(run, kind)


def _predict(own: LanguageModel, col: pa.Array, switch: float, spans: bool = False):
    """Index of each row's language (one past the last: unknown), its score, and spans if asked for."""
    n, k = len(col), len(own.langs)
    pred, score, found = np.full(n, k), np.zeros(n), [[] for _ in range(n if spans else 0)]
    for i, j, data, rows in passes(col):
        starts, ends = word_bounds(data, _LETTER)
        at = np.searchsorted(starts, rows)
        best = viterbi(own.word_scores(data, starts, ends), at, switch)
        row = np.repeat(np.arange(j - i), np.diff(at))
        size = np.bincount(row * k + best, ends - starts, (j - i) * k).reshape(j - i, -1)
        top, total = size.argmax(1), size.sum(1)
        ascii_letter = np.add.reduceat((data >= 97) & (data < 123), rows[:-1]) > 0
        for r in np.flatnonzero(~ascii_letter & (total > 0)):
            if not _has_letter(col[i + int(r)].as_py()):
                total[r] = 0
        some = np.flatnonzero(total > 0)
        pred[i + some] = top[some]
        score[i + some] = size[some, top[some]] / total[some]
        for r in range(j - i if spans else 0):
            s = best[at[r] : at[r + 1]]
            edge = [0, *(np.flatnonzero(np.diff(s)) + 1).tolist(), len(s)]
            found[i + r] = [
                {"lang": own.langs[s[x]], "first": x, "end": y} for x, y in zip(edge[:-1], edge[1:], strict=True) if y > x
            ]
    return pred, score, found


def keep_identified(
    docs: DataFrame, model: LanguageModel, text_col: str = "text", switch: float = SWITCH, least: float = 0.0
) -> DataFrame:
    """Rows of ``docs``, as they are, whose text has an identified language, however many it has.

    Texts that are null or have no letter go; so do, if ``least`` is given, those whose main language covers less of
    their letters.
    """
    shared = bounded(docs).sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for b in small_batches(batches, text_col, 4 << 20):
            pred, score, _ = _predict(own, b.column(text_col), switch)
            yield b.filter(pa.array((pred < len(own.langs)) & (score >= least)))

    return docs.mapInArrow(run, docs.schema)


def fold(id_col: Column, n: int) -> Column:
    """The remainder of the CRC-32 of the id as text; null for a null id."""
    return F.crc32(id_col.cast("string")) % n
