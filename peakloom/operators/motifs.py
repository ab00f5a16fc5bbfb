"""Motif matrices and scanning.

A motif collection is a long table (``motif_id, name, kind, symmetry, block, row, base,
value, positions``): block 0 is the matrix itself, further blocks are dependencies whose
rows spell the k-mers of ``positions`` four at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.codes import CODES, pieces
from ..runtime import cut_lineage

BASES = "ACGT"
#: Score of a window with unknown bases, and of a sequence shorter than the motif.
UNKNOWN_SCORE, SHORT_SCORE = -999.0, -66.0
#: Fixed value: pseudo-count of frequency matrices.
FREQUENCY_PSEUDO = 1.0 / 600
#: Columns of one look-up in a thresholded scan; its table has 5 ** LOOK_UP cells.
LOOK_UP = 6
#: Letters that are scanned at once: arrays of a number each stay in the cache.
SCAN = 1 << 17
#: A window stays while its best reachable score is less than this share of the largest possible sum below
#: the threshold, since sums in another order round differently.
SLACK = 1e-9
MOTIF_SCHEMA = (
    "motif_id string, name string, kind string, symmetry string, block int, row int, base string, "
    "value double, positions array<int>"
)
SITE_SCHEMA = "motif_id string, seq_id long, pos int, stop int, strand string, kmer string, type string, motif_len int, score double"


def motif_rows(motif_id: str, kind: str, symmetry: str, matrix: Sequence[Sequence[float]]) -> list[tuple]:
    """Rows of the long table for a plain matrix."""
    return [
        (motif_id, motif_id, kind, symmetry, 0, i + 1, b, float(line[j]), None)
        for i, line in enumerate(matrix) for j, b in enumerate(BASES)
    ]


def pfm_to_pwm(motifs: DataFrame) -> DataFrame:
    """Turn COUNT and FREQUENCY matrices into log scores, ``ln((f+pc)/(fmax+pc))``.

    Counts become row frequencies; they get a pseudo-count of 1/largest row total only
    if some count is zero.  SCORE matrices pass unchanged.
    """
    line = W.partitionBy("motif_id", "block", "row")
    matrix = W.partitionBy("motif_id", "block")
    is_count = F.col("kind") == "COUNT"
    out = motifs.withColumn("_total", F.sum("value").over(line))
    out = out.withColumn("_freq", F.when(is_count, F.col("value") / F.col("_total")).otherwise(F.col("value")))
    out = out.withColumn("_most", F.max("_total").over(matrix)).withColumn("_least", F.min("value").over(matrix))
    pseudo = F.when(
        is_count, F.when(F.col("_least") == 0, 1 / F.col("_most")).otherwise(F.lit(0.0))
    ).otherwise(F.lit(FREQUENCY_PSEUDO))
    score = F.log((F.col("_freq") + pseudo) / (F.max("_freq").over(line) + pseudo))
    out = out.withColumn("_score", F.when(F.col("kind") == "SCORE", F.col("value")).otherwise(score))
    return out.withColumn("value", F.col("_score")).withColumn("kind", F.lit("SCORE")).select(*motifs.columns)


def rc_matrix(motifs: DataFrame) -> DataFrame:
    """Reverse-complement matrix: rows in reverse order with A-T and C-G swapped."""
    length = F.max("row").over(W.partitionBy("motif_id", "block"))
    return (
        motifs.withColumn("_r", length + 1 - F.col("row")).withColumn("row", F.col("_r"))
        .withColumn("base", F.translate("base", "ACGT", "TGCA")).select(*motifs.columns)
    )


@dataclass
class Model:
    """One motif as arrays, small enough to ship with a task."""

    motif_id: str
    symmetric: bool
    matrix: np.ndarray
    blocks: list[tuple[list[int], np.ndarray]] = field(default_factory=list)

    @property
    def length(self) -> int:
        return len(self.matrix)

    def reverse(self) -> "Model":
        """The model of the other strand."""
        flipped = []
        for positions, table in self.blocks:
            k = len(positions)
            cube = table.reshape((4,) * k)[(slice(None, None, -1),) * k].transpose(range(k)[::-1])
            flipped.append((sorted(self.length - p + 1 for p in positions), cube.ravel()))
        return Model(self.motif_id, self.symmetric, self.matrix[::-1, ::-1], flipped)


def collect_models(pwm: DataFrame) -> list[Model]:
    """Bring score matrices (model parameters, not data) to the driver."""
    rows = pwm.orderBy("motif_id", "block", "row", "base").collect()
    models: dict[str, Model] = {}
    tables: dict[tuple[str, int], list] = {}
    for r in rows:
        tables.setdefault((r.motif_id, r.block), []).append(r)
    for (motif_id, block), cells in sorted(tables.items()):
        values = np.array([c.value for c in cells])
        if block == 0:
            models[motif_id] = Model(motif_id, cells[0].symmetry == "SYMMETRIC", values.reshape(-1, 4))
        else:
            models[motif_id].blocks.append((list(cells[0].positions), values))
    return list(models.values())


def _parts(model: Model) -> tuple[list[int], list[tuple[list[int], np.ndarray]]]:
    """The columns (from 0) that are scored on their own, and the dependencies by first position."""
    inside = {p - 1 for positions, _ in model.blocks for p in positions}
    starts = {positions[0] - 1: (positions, table) for positions, table in model.blocks}
    return [j for j in range(model.length) if j not in inside], [starts[j] for j in sorted(starts)]


def _first_columns(model: Model) -> np.ndarray | None:
    """Scores of the words of the first ``LOOK_UP`` columns, added up in their order; None if these do not stand alone."""
    if _parts(model)[0][:LOOK_UP] != list(range(LOOK_UP)):
        return None
    total = np.zeros(1)
    for line in model.matrix[:LOOK_UP]:
        total = (total[:, None] + np.append(line, 0.0)).ravel()
    return total


def _window_scores(
    codes: np.ndarray, model: Model, at: np.ndarray | None = None, words: np.ndarray | None = None, first: np.ndarray | None = None
) -> np.ndarray:
    """Score of the window at every offset of a coded sequence (4 = unknown base), or at the offsets ``at``.

    For all offsets the first columns are looked up at once, given :func:`_words_at` and :func:`_first_columns`.
    """
    size, n = model.length, len(codes) - model.length + 1 if at is None else len(at)
    column = lambda j: codes[j:j + n] if at is None else codes[at + j]
    plain, blocks = _parts(model)
    starts = {positions[0] - 1: (positions, table) for positions, table in blocks}
    total = np.zeros(n) if first is None else first[words[:n]]
    unknown = np.zeros(n, bool)
    clean = at is None and not (codes == 4).any()
    for j in range(size):
        letters = column(j)
        if not clean:
            unknown |= letters == 4
        if first is not None and j < LOOK_UP:
            continue
        if j in starts:
            positions, table = starts[j]
            index = np.zeros(n, np.int64)
            for p in positions:
                index = index * 4 + np.minimum(column(p - 1), 3)
            total += table[index]
        elif j in plain:
            total += np.append(model.matrix[j], 0.0)[letters]
    total[unknown] = UNKNOWN_SCORE
    return total


class LookAhead:
    """Which windows of a motif can still exceed a threshold, after some of its columns.

    The columns are read in pieces, those with the most to lose first.  After each piece a window is
    dropped if the best letters in all other columns would not bring it above the threshold.  The first
    piece is a stretch of ``LOOK_UP`` columns: one look-up in a table of its words tells what stays.
    """

    def __init__(self, model: Model, threshold: float):
        plain, blocks = _parts(model)
        loss = {j: model.matrix[j].max() - model.matrix[j].mean() for j in plain}
        runs = [list(range(j, j + LOOK_UP)) for j in plain if all(i in loss for i in range(j, j + LOOK_UP))]
        first = max(runs, key=lambda run: sum(loss[j] for j in run), default=None)
        rest = sorted((j for j in plain if j not in (first or [])), key=lambda j: -loss[j])
        pieces = [(first, self._words(model.matrix[first]))] if first else []
        pieces += [([p - 1 for p in positions], self._with_unknown(table, len(positions))) for positions, table in blocks]
        pieces += [(rest[i:i + 3], self._words(model.matrix[rest[i:i + 3]])) for i in range(0, len(rest), 3)]
        best = np.array([table.max() for _, table in pieces])
        # A piece is left with the least partial score that the best of all later pieces can still lift.
        cells = np.concatenate([model.matrix.ravel(), *(table for _, table in blocks)])
        slack = SLACK * (1 + model.length * np.abs(cells[np.isfinite(cells)]).max(initial=0))
        needed = threshold - slack - (best.sum() - np.cumsum(best))
        self.first = first[0] if first else None
        self.may = pieces[0][1] >= needed[0] if first else None
        self.pieces = list(zip(*zip(*pieces), needed)) if pieces else []

    @staticmethod
    def _words(matrix: np.ndarray) -> np.ndarray:
        total = np.zeros(1)
        for line in matrix:
            total = (total[:, None] + np.append(line, -np.inf)).ravel()
        return total

    @staticmethod
    def _with_unknown(table: np.ndarray, k: int) -> np.ndarray:
        full = np.full((5,) * k, -np.inf)
        full[(slice(0, 4),) * k] = table.reshape((4,) * k)
        return full.ravel()

    def left(self, codes: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
        """Offsets of the windows that may score above the threshold; ``words`` are :func:`_words_at`."""
        n = len(codes) - size + 1
        if self.first is None:
            at = np.arange(n)
        else:
            at = np.flatnonzero(self.may[words[self.first:self.first + n]])
        total = np.zeros(len(at))
        for columns, table, needed in self.pieces:
            index = np.zeros(len(at), np.int64)
            for j in columns:
                index = index * 5 + codes[at + j]
            total += table[index]
            stay = total >= needed
            at, total = at[stay], total[stay]
        return at


def _words_at(codes: np.ndarray) -> np.ndarray:
    """Number of the word of ``LOOK_UP`` letters at every offset."""
    n = max(len(codes) - LOOK_UP + 1, 0)
    words = np.zeros(n, np.uint16)
    for j in range(LOOK_UP):
        words *= 5
        words += codes[j:j + n]
    return words


def _scan_batches(batches, models, threshold, bases=SCAN):
    reach = max((m.length for m in models), default=1) - 1
    # Below the score of unknown letters every window counts.
    prune = threshold is not None and threshold >= UNKNOWN_SCORE
    views = [
        (m, [(strand, view, LookAhead(view, threshold) if prune else _first_columns(view)) for strand, view in
             ([("+", m)] if m.symmetric else [("+", m), ("-", m.reverse())])])
        for m in models
    ]
    for batch in batches:
        for ids, offsets, data, place, own, whole in pieces(batch, reach, bases):
            codes, ends = CODES[data], offsets[1:]
            words = _words_at(codes)
            owner = np.repeat(np.arange(len(ids)), np.diff(offsets))
            for model, strands in views:
                size = model.length
                short = np.flatnonzero(whole < size)
                # The last start of each sequence, and at each letter.
                last = np.minimum(ends - size, offsets[:-1] + own - 1)
                inside = np.arange(len(codes)) <= np.repeat(last, np.diff(offsets)) if not prune else None
                for strand, view, ahead in strands:
                    if len(codes) >= size:
                        home = owner[:len(codes) - size + 1]
                        if prune:
                            at = ahead.left(codes, words, size)
                            score = np.empty(len(home))
                            score[at] = _window_scores(codes, view, at)
                            mine = home[at]
                            at = at[(at <= last[mine]) & (score[at] > threshold)]
                        else:
                            score = _window_scores(codes, view, None, words, ahead)
                            at = np.flatnonzero(inside[:len(score)])
                            if threshold is not None:
                                at = at[score[at] > threshold]
                    else:
                        score, at = np.zeros(0), np.zeros(0, int)
                        home = at
                    yield model, strand, ids, offsets - np.append(place, 0), data, home, at, score, short


def scan_pwm(
    sequences: DataFrame, models: Sequence[Model], threshold: float | None = None,
    id_col: str = "seq_id", seq_col: str = "seq", with_kmer: bool = True,
) -> DataFrame:
    """Score every window of every sequence on both strands (one strand if symmetric).

    Returns the site table with 1-based ``pos``; only scores above ``threshold`` are
    emitted, and a window is left as soon as the best of its remaining columns cannot lift it
    above (:class:`LookAhead`).  Windows with other letters than ACGT score -999 and a sequence
    shorter than the motif gets one row with -66.
    """
    source = sequences.select(F.col(id_col).cast("long").alias("seq_id"), F.col(seq_col).alias("seq"))

    def scan(batches):
        for model, strand, ids, offsets, data, home, at, score, short in _scan_batches(batches, models, threshold):
            size, n = model.length, len(at)
            if n and with_kmer:
                windows = np.lib.stride_tricks.sliding_window_view(data, size)[at]
                words = pa.array(np.ascontiguousarray(windows).view(f"S{size}").ravel()).cast(pa.string())
            else:
                words = pa.nulls(n, pa.string())
            if n:
                pos = at - offsets[home[at]] + 1
                yield _site_batch(model, strand, ids[home[at]], pos, words, score[at])
            if len(short) and (threshold is None or SHORT_SCORE > threshold):
                first = pa.array([chr(data[offsets[i]]) if offsets[i + 1] > offsets[i] else "" for i in short])
                yield _site_batch(
                    model, strand, ids[short], np.ones(len(short)), first, np.full(len(short), SHORT_SCORE)
                )

    return source.mapInArrow(scan, SITE_SCHEMA)


def _bound(score: np.ndarray, a: float, b: float) -> np.ndarray:
    bound = np.exp((score - b) / a) * np.exp(b / a)
    return bound / (1 + bound)


def scan_best(
    sequences: DataFrame, models: Sequence[Model], id_col: str = "seq_id", seq_col: str = "seq", with_occupancy: bool = False
) -> DataFrame:
    """Best site of every sequence and motif, as :func:`best_site` over a full scan gives it.

    Each task keeps one candidate per sequence and strand, so a full scan moves no windows.
    ``with_occupancy`` adds the ``occupancy`` of :func:`scan_occupancy` from the same scan.
    """
    source = sequences.select(F.col(id_col).cast("long").alias("seq_id"), F.col(seq_col).alias("seq"))

    def candidates(bound, *site):
        batch = _site_batch(*site)
        return batch.append_column("occupancy", pa.array(bound)) if with_occupancy else batch

    def scan(batches):
        for model, strand, ids, offsets, data, home, at, score, short in _scan_batches(batches, models, None):
            if len(at):
                owner, found = home[at], score[at]
                # Starts are in order of their sequences.
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                top = np.repeat(np.maximum.reduceat(found, first), np.diff(np.append(first, len(at))))
                best = np.flatnonzero(found == top)
                best = at[best[np.flatnonzero(np.diff(owner[best], prepend=-1))]]
                bound = np.bincount(owner, _bound(found, 1.0, 0.0), len(ids))[home[best]] if with_occupancy else None
                windows = np.lib.stride_tricks.sliding_window_view(data, model.length)[best]
                words = pa.array(np.ascontiguousarray(windows).view(f"S{model.length}").ravel()).cast(pa.string())
                yield candidates(bound, model, strand, ids[home[best]], best - offsets[home[best]] + 1, words, score[best])
            if len(short):
                first = pa.array([chr(data[offsets[i]]) if offsets[i + 1] > offsets[i] else "" for i in short])
                score = np.full(len(short), SHORT_SCORE)
                yield candidates(_bound(score, 1.0, 0.0), model, strand, ids[short], np.ones(len(short)), first, score)

    if not with_occupancy:
        return best_site(source.mapInArrow(scan, SITE_SCHEMA))
    return best_site(source.mapInArrow(scan, SITE_SCHEMA + ", occupancy double"), total="occupancy")


def scan_occupancy(
    sequences: DataFrame, models: Sequence[Model], a: float = 1.0, b: float = 0.0, id_col: str = "seq_id", seq_col: str = "seq"
) -> DataFrame:
    """Predicted occupancy of every sequence and motif over all its windows, summed inside the scan."""
    source = sequences.select(F.col(id_col).cast("long").alias("seq_id"), F.col(seq_col).alias("seq"))

    def scan(batches):
        for model, _, ids, offsets, _, home, at, score, short in _scan_batches(batches, models, None):
            bound = _bound(np.append(score[at], np.full(len(short), SHORT_SCORE)), a, b)
            total = np.bincount(np.append(home[at], short), bound, len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(model.motif_id, len(ids)), pa.array(ids.astype(np.int64)), pa.array(total)],
                names=["motif_id", "seq_id", "occupancy"],
            )

    out = source.mapInArrow(scan, "motif_id string, seq_id long, occupancy double")
    return out.groupBy("motif_id", "seq_id").agg(F.sum("occupancy").alias("occupancy"))


def _site_batch(model, strand, ids, pos, words, score) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.repeat(model.motif_id, n), pa.array(ids.astype(np.int64)), pa.array(pos.astype(np.int32)),
            pa.array((pos + model.length).astype(np.int32)), pa.repeat(strand, n), words,
            pa.repeat("PWM", n), pa.array(np.full(n, model.length, np.int32)), pa.array(score.astype(float)),
        ],
        names=["motif_id", "seq_id", "pos", "stop", "strand", "kmer", "type", "motif_len", "score"],
    )


def scan_score_counts(
    sequences: DataFrame, models: Sequence[Model], id_col: str = "seq_id", seq_col: str = "seq"
) -> DataFrame:
    """How often each score occurs per motif and strand, ``(motif_id, strand, score, n)``.

    Scores are counted inside the scan, so the shuffle carries distinct scores only.
    """
    source = sequences.select(F.col(id_col).cast("long").alias("seq_id"), F.col(seq_col).alias("seq"))

    def scan(batches):
        for model, strand, *_, at, score, short in _scan_batches(batches, models, None):
            values, n = np.unique(np.append(score[at], np.full(len(short), SHORT_SCORE)), return_counts=True)
            if len(values):
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(model.motif_id, len(n)), pa.repeat(strand, len(n)), pa.array(values), pa.array(n.astype(np.int64))],
                    names=["motif_id", "strand", "score", "n"],
                )

    out = source.mapInArrow(scan, "motif_id string, strand string, score double, n long")
    # Distinct scores are few beside the windows and every consumer reads them several times.
    return cut_lineage(out.groupBy("motif_id", "strand", "score").agg(F.sum("n").alias("n")))


def best_site(sites: DataFrame, keys: Sequence[str] = ("motif_id", "seq_id"), total: str | None = None) -> DataFrame:
    """Highest-scoring site per sequence; ties go to the first position, ``+`` strand first.  The column ``total`` is added up."""
    rest = [c for c in sites.columns if c not in keys and c != total]
    top = F.max_by(
        F.struct(*rest), F.struct(F.col("score"), -F.col("pos"), F.when(F.col("strand") == "+", 1).otherwise(0))
    ).alias("s")
    more = [F.sum(total).alias(total)] if total else []
    return sites.groupBy(*keys).agg(top, *more).select(*keys, *[F.col(f"s.{c}").alias(c) for c in rest], *([total] if total else []))


def leading_sites(sites: DataFrame, keys: Sequence[str] = ("motif_id", "seq_id")) -> DataFrame:
    """Of each batch of sites those with the highest score of their key, among them all that :func:`best_site` chooses from.

    A scan gives the sites of a sequence one after the other, so few are left to be sorted by key.
    """
    keys = list(keys)

    def lead(batches):
        for batch in batches:
            code = np.zeros(len(batch), np.int64)
            for key in keys:
                number = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
                code = np.unique(code * (number.max(initial=0) + 1) + number, return_inverse=True)[1]
            score = batch.column("score").cast(pa.float64())
            known = pc.is_valid(score).to_numpy(zero_copy_only=False)
            value = pc.fill_null(score, 0.0).to_numpy() + 0.0
            bits = np.where(np.isnan(value), np.nan, value).view(np.int64)
            # In the order of Spark: null, numbers, NaN.
            worth = np.where(known, np.where(bits < 0, bits ^ np.int64((1 << 63) - 1), bits), np.iinfo(np.int64).min)
            top = np.full(code.max(initial=-1) + 1, np.iinfo(np.int64).min)
            np.maximum.at(top, code, worth)
            yield batch.take(pa.array(np.flatnonzero(worth == top[code])))

    return sites.mapInArrow(lead, sites.schema)


def occupancy(sites: DataFrame, a: float = 1.0, b: float = 0.0, keys: Sequence[str] = ("motif_id", "seq_id")) -> DataFrame:
    """Predicted occupancy per sequence: sum of K*TF/(1+K*TF) with K = exp(-(b-s)/a), TF = exp(b/a)."""
    bound = F.exp((F.col("score") - b) / a) * F.exp(F.lit(b / a))
    return sites.groupBy(*keys).agg(F.sum(bound / (1 + bound)).alias("occupancy"))


def site_to_genome(sites: DataFrame, regions: DataFrame, id_col: str = "seq_id") -> DataFrame:
    """Genome coordinates (0-based half-open) of sites from the region each sequence came from."""
    place = regions.select(id_col, "chrom", F.col("start").alias("_s"))
    return (
        sites.join(place, id_col)
        .withColumn("start", F.col("_s") + F.col("pos") - 1)
        .withColumn("end", F.col("_s") + F.col("pos") - 1 + F.col("motif_len")).drop("_s")
    )


def pfm_from_sites(df: DataFrame, seq_col: str = "seq", keys: Sequence[str] = ()) -> DataFrame:
    """Count of each base per column of equal-length sites."""
    letters = df.select(*keys, F.posexplode(F.split(F.col(seq_col), "")).alias("i", "base")).where(F.col("base").isin(*BASES))
    counts = letters.groupBy(*keys, (F.col("i") + 1).alias("pos")).agg(
        *[F.count_if(F.col("base") == b).alias(b) for b in BASES]
    )
    return counts


def _shift(part: DataFrame, by: Column) -> DataFrame:
    return part.withColumn("row", F.col("row") + by)


def compose_dimers(
    motifs: DataFrame, candidates: DataFrame, offset_left: int = 0, offset_right: int = 0
) -> DataFrame:
    """Two-copy matrices for candidate rows ``(motif_id, conf, spacing)``.

    ER puts the reverse complement first, IR last, DR repeats the motif; rows of 1
    fill the spacer, whose length is reduced by the offsets.
    """
    pairs = candidates.select(
        F.col("motif_id").alias("motif_1"), F.col("motif_id").alias("motif_2"), "conf", "spacing"
    )
    return compose_hetero(
        motifs, pairs, (offset_left, offset_right), (offset_left, offset_right), homotypic=True
    )


def compose_hetero(
    motifs: DataFrame, candidates: DataFrame, offsets_1: tuple[int, int] = (0, 0),
    offsets_2: tuple[int, int] = (0, 0), homotypic: bool = False,
) -> DataFrame:
    """Two-motif matrices for ``(motif_1, motif_2, conf, spacing)``, conf in ER, IR, DR, DR12, DR21."""
    (l1, r1), (l2, r2) = offsets_1, offsets_2
    conf = F.col("conf")
    trimmed = (
        F.when(conf == "IR", F.lit(r1 + r2)).when(conf == "ER", F.lit(l1 + l2))
        .when(conf == "DR21", F.lit(r2 + l1)).otherwise(F.lit(r1 + l2))
    )
    swap = conf == "DR21"
    plan = candidates.select(
        F.concat_ws("_", *(["motif_1"] if homotypic else ["motif_1", "motif_2"]), "conf", F.col("spacing").cast("string")).alias("dimer_id"),
        F.when(swap, F.col("motif_2")).otherwise(F.col("motif_1")).alias("head"),
        F.when(swap, F.col("motif_1")).otherwise(F.col("motif_2")).alias("tail"),
        "conf", F.greatest(F.col("spacing") - trimmed, F.lit(0)).cast("int").alias("gap"),
    )
    flat = motifs.where("block = 0").select("motif_id", "row", "base", "value")
    turned = rc_matrix(motifs.where("block = 0")).select("motif_id", "row", "base", "value")
    both = flat.withColumn("turned", F.lit(False)).unionByName(turned.withColumn("turned", F.lit(True)))
    sizes = flat.groupBy("motif_id").agg(F.max("row").alias("len"))
    plan = plan.join(sizes.withColumnsRenamed({"motif_id": "head", "len": "head_len"}), "head")
    head = plan.join(both.withColumnRenamed("motif_id", "head"), "head").where(F.col("turned") == (conf == "ER"))
    tail = plan.join(both.withColumnRenamed("motif_id", "tail"), "tail").where(F.col("turned") == (conf == "IR"))
    spacer = plan.where("gap > 0").withColumn("i", F.explode(F.sequence(F.lit(1), F.col("gap")))).withColumn(
        "base", F.explode(F.array(*[F.lit(b) for b in BASES]))
    )
    cols = ["dimer_id", "conf", "row", "base", "value"]
    rows = (
        head.select(*cols)
        .unionByName(_shift(tail, F.col("head_len") + F.col("gap")).select(*cols))
        .unionByName(spacer.select("dimer_id", "conf", (F.col("head_len") + F.col("i")).alias("row"), "base", F.lit(1.0).alias("value")))
    )
    symmetry = F.when(F.lit(homotypic) & conf.isin("ER", "IR"), "SYMMETRIC").otherwise("ASYMMETRIC")
    return rows.select(
        F.col("dimer_id").alias("motif_id"), F.col("dimer_id").alias("name"), F.lit("COUNT").alias("kind"),
        symmetry.alias("symmetry"), F.lit(0).alias("block"), F.col("row").cast("int").alias("row"), "base", "value",
        F.lit(None).cast("array<int>").alias("positions"),
    )


def score_with_model(df: DataFrame, fn, schema: str) -> DataFrame:
    """Apply a batch scorer ``fn(pandas.DataFrame) -> pandas.DataFrame`` in the tasks."""
    def run(frames):
        for frame in frames:
            yield fn(frame)
    return df.mapInPandas(run, schema)


def train_site_classifier(
    df: DataFrame, features: Sequence[str], label: str = "label", seed: int = 0, train_share: float = 0.8
):
    """Fit a gradient-boosted classifier on an 80/20 split; returns (model, scored test rows)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    from .sampling import split_percent

    parts = split_percent(df, train_share * 100, seed, id_col="seq_id", strata=[label])
    pipe = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            GBTClassifier(labelCol=label, featuresCol="features", maxIter=10, seed=seed),
        ]
    )
    model = pipe.fit(parts.where("part = 'train'"))
    scored = model.transform(parts.where("part = 'test'"))
    return model, scored.select("seq_id", label, vector_to_array("probability")[1].alias("probability"))


def add_scores_to_table(
    peaks: DataFrame, sequences: DataFrame, models: Sequence[Model], id_col: str = "seq_id", with_occupancy: bool = False
) -> DataFrame:
    """Best site start, stop and score (and occupancy) per motif, appended to a peak table."""
    stats = scan_best(sequences, models, id_col, with_occupancy=with_occupancy).where("seq_id IS NOT NULL")
    value = lambda m, c: F.max(F.when(F.col("motif_id") == m, F.col(c))).alias(f"{m}_{c}")
    names = ["pos", "stop", "score", *(["occupancy"] if with_occupancy else [])]
    wide = stats.groupBy("seq_id").agg(*[value(m.motif_id, c) for m in models for c in names])
    return peaks.join(wide.withColumnRenamed("seq_id", id_col), id_col, "left")
