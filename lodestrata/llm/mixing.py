"""Mixing sources to target weights, with soft membership in domains.

A naive Bayes classifier, fitted on the labelled table, gives every document a
posterior over domains. Its features are the words that a text contains and the
signs that its tokens end in; of those, the ones that tell domains apart with
statistical weight are kept, and how much they count and the priors are
calibrated so that on the labelled rows posteriors are as large as they are
often right. Nonnegative document rates are then fitted so that the
expected tokens of each domain, ``T_k = sum_i r_i n_i p_ik``, meet their
targets: projected gradient on ``1/2 sum_k (T_k - t_k)^2 / t_k`` from rates of
one, each step in the metric of the documents' lengths. In that metric a step
changes a rate by ``sum_k p_ik g_k``, so documents with the same posterior keep
the same rate. Documents are put into the cells of a grid of posteriors, one
small table; a cell carries the summed tokens of its exact posteriors, and its
documents have one rate, so that sums over cells are sums over documents.

Native DataFrame code throughout. What comes to the driver is bounded: the log
likelihoods of the labelled rows, one sum for each domain and step.
"""

from __future__ import annotations

from math import log
from warnings import warn

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Labelled rows to fit on at most; as text, they are read where they are.
SAMPLE = 8000
#: Features that are kept: in so many labelled rows, with odds so many standard errors from one, and by that factor (natural logarithm).
LEAST_ROWS, LEAST_Z, LEAST_LIFT = 5, 3.5, 1.5
#: Features kept at most, those with the greatest weight of evidence; a text's are one bit each.
FEATURES = 256
#: By how much evidence may be discounted, since features of a text depend on each other.
DISCOUNTS = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 10.0)
#: Steps of the posterior grid; with K domains it has at most (GRID + 1) ** (K - 1) points.
GRID = 64
#: Steps at most; those beyond the tolerance aren't taken.
STEPS, TOLERANCE = 1000, 1e-4

#: Production domains, and their share of all tokens.
TARGETS = {"clean": 0.92, "low": 0.05, "toxic": 0.03}


def domain_of_labels(quality: F.Column, toxic: F.Column) -> F.Column:
    return F.when(toxic == 1, "toxic").when(quality == 0, "low").when(quality == 1, "clean")


SPACES = "[ \\t\\n\\r]+"
#: Signs that are no part of a word at its ends.
SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _token_rows(df: DataFrame, text_col: str, *keep: str) -> DataFrame:
    """A row for each token: its ``word``, and its ``tail`` of up to three signs behind a space. A text without tokens has one with neither."""
    low = F.btrim(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(" \t\n\r"))
    rows = df.select(*keep, F.explode_outer(F.split(low, SPACES)).alias("t")).withColumn("bare", F.rtrim("t", F.lit(SIGNS)))
    word = F.when(F.col("t") != "", F.ltrim("bare", F.lit(SIGNS)))
    return rows.select(*keep, word.alias("word"), F.when(F.col("t") != "", F.concat(F.lit(" "), F.substr("t", F.char_length("bare") + 1, F.lit(3)))).alias("tail"))


def _numbers(values: list[float]) -> F.Column:
    """A constant array, handed over as one string."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def _sum_of_bits(bits: F.Column, values: list[float]) -> F.Column:
    """The sum of the ``values`` whose bit is set."""
    each = F.zip_with(F.sequence(F.lit(0), F.lit(63)), _numbers(values), lambda b, w: F.when(F.call_function("getbit", bits, b) == 1, w).otherwise(0.0))
    return F.aggregate(each, F.lit(0.0), lambda x, y: x + y)


def _informative(counts: DataFrame, totals: list[int]) -> DataFrame:
    """``(f, i, w0, w1 ...)``: number and log-likelihoods by domain of the features that tell domains apart, from ``counts(f, n0, n1 ...)``."""
    k, rows = len(totals), sum(totals)
    n = [F.col(f"n{i}") for i in range(k)]
    seen = sum(n[1:], n[0])
    weights = []
    for i, of in enumerate(totals):
        a, b, c, d = n[i] + 0.5, seen - n[i] + 0.5, F.lit(of) - n[i] + 0.5, F.lit(rows - of) - (seen - n[i]) + 0.5
        odds = F.log(a * d / (b * c))
        z = F.abs(odds) / F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
        weights.append(F.when(F.abs(odds) >= LEAST_LIFT, z).otherwise(0.0))
    best = F.greatest(*weights) if k > 1 else F.lit(0.0)
    kept = cut(counts.where((F.col("f") != "") & (seen >= LEAST_ROWS)).withColumn("z", best).where(F.col("z") >= LEAST_Z).orderBy(F.col("z").desc(), "f").limit(FEATURES))
    numbered = kept.withColumn("i", F.row_number().over(Window.orderBy(F.col("z").desc(), "f")) - 1)
    return numbered.select("f", "i", *(F.log((n[i] + 0.5) / F.lit(totals[i] + 1.0)).alias(f"w{i}") for i in range(k)))


def _calibrated(times: np.ndarray, domain: np.ndarray, evidence: np.ndarray, priors: list[float], rounds: int = 40) -> tuple[float, list[float]]:
    """(discount, log priors) with the least loss on rows of log-likelihoods, of those whose mean posteriors are the domains' shares."""
    share = np.bincount(domain, times, len(priors)) / max(1, times.sum())
    if not share.all():  # a domain without labelled rows has no share to be held to
        return 1.0, priors
    best = None
    for discount in DISCOUNTS:
        log_priors = np.array(priors)
        for step in range(rounds + 1):
            z = log_priors + evidence / discount
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            mean = (times[:, None] * p).sum(axis=0) / times.sum()
            if step == rounds or np.abs(mean - share).max() < 1e-4:
                break
            log_priors += np.log(share) - np.log(np.maximum(mean, 1e-12))
        loss = -(times * np.log(np.maximum(p[np.arange(len(p)), domain], 1e-12))).sum()
        if best is None or loss < best[0]:
            best = loss, discount, log_priors.tolist()
    return best[1], best[2]


def fit_weights(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[float], DataFrame]:
    """Log priors, and ``(f, i, w0, w1 ...)``: what a feature adds to each domain's logit.

    ``labelled(id, domain)``; rows with null id or a domain not named don't
    count. Fitted on at most ``sample`` ids, those with the least hash.
    """
    k = len(domains)
    rows = labelled.where(F.col(id_col).isNotNull() & F.col("domain").isin(domains))
    chosen = rows.groupBy(id_col).agg(F.min("domain").alias("domain")).orderBy(F.xxhash64(id_col), id_col).limit(sample)
    number = F.array_position(F.array(*map(F.lit, domains)), F.col("domain")) - 1
    # At most `sample` rows, which bounds the broadcast.
    texts = docs.select(id_col, text_col).join(F.broadcast(chosen.select(id_col, number.cast("int").alias("d"))), id_col).select("d", text_col)
    tokens = _token_rows(texts.withColumn("row", F.monotonically_increasing_id()), text_col, "row", "d")
    found = cut(tokens.select("row", "d", F.explode(F.array(F.coalesce("word", F.lit("")), F.coalesce("tail", F.lit("")))).alias("f")).distinct())
    counts = {r["d"]: r["n"] for r in found.groupBy("d").agg(F.count_distinct("row").alias("n")).collect()}
    totals = [counts.get(i, 0) for i in range(k)]
    priors = [log((n + 1) / (sum(totals) + k)) for n in totals]
    by_feature = found.groupBy("f").agg(*(F.count_if(F.col("d") == i).alias(f"n{i}") for i in range(k)))
    weights = cut(_informative(by_feature, totals))
    sums = found.join(F.broadcast(weights), "f", "left").groupBy("row", "d").agg(*(F.round(F.coalesce(F.sum(f"w{i}"), F.lit(0.0)), 6).alias(f"s{i}") for i in range(k)))
    names = [f"s{i}" for i in range(k)]
    evidence = sums.groupBy("d", *names).agg(F.count("*").alias("times")).orderBy("d", *names).collect()
    discount, priors = _calibrated(np.array([r["times"] for r in evidence], float), np.array([r["d"] for r in evidence], int), np.array([[r[n] for n in names] for r in evidence]).reshape(-1, k), priors)
    return priors, weights.select("f", "i", *((F.col(f"w{i}") / discount).alias(f"w{i}") for i in range(k)))


def _row_hash(id_col: str, source_col: str, text_col: str) -> F.Column:
    """The same for rows that are the same in what a rate depends on; nulls differ from all else."""
    return F.xxhash64(*(x for c in (id_col, source_col, text_col) for x in (F.col(c), F.col(c).isNull())))


def posteriors(docs: DataFrame, priors: list[float], weights: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(id, source, h, n_tokens, p, q)`` of every row; ``p`` the posterior, ``q`` its cell in steps of 1 / GRID, the first domain taking the rest, ``h`` a hash of the row."""
    k = len(priors)
    keyed = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"), _row_hash(id_col, source_col, text_col).alias("h"))
    masks = range(FEATURES // 64)
    # At most FEATURES rows, which bounds the broadcasts.
    bits = [F.when(F.floor(F.col("i") / 64) == m, F.expr("shiftleft(1L, cast(i % 64 as int))")).otherwise(F.lit(0).cast("long")) for m in masks]
    of_word = F.broadcast(weights.select(F.col("f").alias("word"), *(bits[m].alias(f"a{m}") for m in masks)))
    of_tail = F.broadcast(weights.select(F.col("f").alias("tail"), *(bits[m].alias(f"b{m}") for m in masks)))
    found = _token_rows(keyed, "text", "row", "id", "source", "h").join(of_word, "word", "left").join(of_tail, "tail", "left")
    zero = F.lit(0).cast("long")
    has = [F.bit_or(F.coalesce(f"a{m}", zero).bitwiseOR(F.coalesce(f"b{m}", zero))).alias(f"has{m}") for m in masks]
    each = found.groupBy("row", "id", "source", "h").agg(F.count("word").alias("n_tokens"), *has)
    table = {r["i"]: [r[f"w{j}"] for j in range(k)] for r in weights.collect()}

    def evidence(j):
        """What the features that a text has add to the logit of domain ``j``."""
        total = F.lit(0.0)
        for m in masks:
            here = [table[i][j] if i in table else 0.0 for i in range(64 * m, 64 * m + 64)]
            if any(here):
                total += _sum_of_bits(F.col(f"has{m}"), here)
        return total

    logits = each.select("id", "source", "h", "n_tokens", *((F.lit(priors[i]) + evidence(i)).alias(f"z{i}") for i in range(k)))
    top = F.greatest(*(f"z{i}" for i in range(k))) if k > 1 else F.col("z0")
    powers = logits.select("id", "source", "h", "n_tokens", *(F.exp(F.col(f"z{i}") - top).alias(f"e{i}") for i in range(k)))
    whole = sum((F.col(f"e{i}") for i in range(1, k)), F.col("e0"))
    p = F.array(*(F.col(f"e{i}") / whole for i in range(k)))
    steps = [F.floor(F.col(f"e{i}") / whole * GRID).cast("int") for i in range(1, k)]
    rest = F.lit(GRID) - sum(steps[1:], steps[0]) if steps else F.lit(GRID)
    return powers.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "h", "n_tokens", p.alias("p"), F.array(rest, *steps).alias("q"))


def cells(members: DataFrame, k: int) -> DataFrame:
    """``(cell, n_tokens, q)``: the tokens of each cell and its documents' mean posterior by tokens, in units of 1 / GRID."""
    sums = [F.sum(F.col("n_tokens") * F.get("p", F.lit(i))).alias(f"s{i}") for i in range(k)]
    summed = members.groupBy(F.col("q").alias("cell")).agg(F.sum("n_tokens").alias("n_tokens"), *sums)
    mean = [F.when(F.col("n_tokens") > 0, F.col(f"s{i}") / F.col("n_tokens") * GRID).otherwise(F.get("cell", F.lit(i)).cast("double")) for i in range(k)]
    return summed.select("cell", "n_tokens", F.array(*mean).alias("q"))


def _rate(history: list[list[float]], k: int) -> F.Column:
    """The rate after all steps so far: start at one, move, stay nonnegative."""
    if not history:
        return F.lit(1.0)
    flat = _numbers([g for step in history for g in step])

    def move(r, t):
        change = sum((F.get(F.col("q"), F.lit(i)) * F.get(flat, t * k + i) for i in range(1, k)), F.get(F.col("q"), F.lit(0)) * F.get(flat, t * k))
        return F.greatest(F.lit(0.0), r - change / GRID)

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(history) - 1)), F.lit(1.0), move)


def fit_rates(members: DataFrame, targets: list[float], steps: int = STEPS, tolerance: float = TOLERANCE) -> list[list[float]]:
    """The gradient steps that lead to the rates; ``targets`` are expected tokens by domain.

    Works on a table with one row for each point of the posterior grid, summed
    over all documents. Those points are then one array, and all steps one
    expression over it: by turns the gradient is summed over the points, and
    their rates move. Warns if the sums aren't within ``tolerance`` of the
    targets after ``steps``.
    """
    k = len(targets)
    points = cut(members.groupBy("q").agg(F.sum("n_tokens").cast("double").alias("n")))
    q = [F.get(F.col("q"), F.lit(i)) / GRID for i in range(k)]
    total = sum(targets)
    if not total:
        return []
    weight = [1 / max(t, 1e-3 * total) for t in targets]
    gram = points.agg(*(F.sum(F.col("n") * q[i] * q[j]).alias(f"m{i}_{j}") for i in range(k) for j in range(k))).first()
    bound = max(sum(abs(gram[f"m{i}_{j}"] or 0.0) * (weight[i] * weight[j]) ** 0.5 for j in range(k)) for i in range(k))
    if not bound:
        return []

    def expected(state, i):
        each = F.zip_with("points", state["rates"], lambda p, r: p["n"] * r * F.get(p["q"], F.lit(i)) / GRID)
        return F.aggregate(each, F.lit(0.0), lambda x, y: x + y)

    def state(rates, errors, history, done):
        return F.struct(rates.alias("rates"), errors.alias("errors"), history.alias("history"), done.alias("done"))

    def gradient(s):
        return [F.get(s["errors"], F.lit(i)) * F.lit(weight[i] / bound) for i in range(k)]

    def turn(s, t):
        summed = state(s["rates"], F.array(*(expected(s, i) - F.lit(targets[i]) for i in range(k))), s["history"], s["done"])
        near = F.array_max(F.transform(s["errors"], F.abs)) <= F.lit(tolerance * total)
        g = gradient(s)
        rates = F.zip_with("points", s["rates"], lambda p, r: F.greatest(F.lit(0.0), r - sum((F.get(p["q"], F.lit(i)) * g[i] for i in range(1, k)), F.get(p["q"], F.lit(0)) * g[0]) / GRID))
        moved = state(rates, s["errors"], F.concat(s["history"], F.array(F.array(*g))), F.lit(False))
        settled = state(s["rates"], s["errors"], s["history"], F.lit(True))
        return F.when(s["done"], s).when(t % 2 == 0, summed).when(near, settled).otherwise(moved)

    start = state(F.transform("points", lambda p: F.lit(1.0)), F.array(*[F.lit(0.0)] * k), F.array().cast("array<array<double>>"), F.lit(False))
    packed = points.agg(F.collect_list(F.struct(F.col("n"), F.transform("q", lambda x: x.cast("double")).alias("q"))).alias("points"))
    # Steps come after even turns, so a last sum follows the last step.
    run = packed.select(F.aggregate(F.sequence(F.lit(0), F.lit(2 * steps)), start, turn).alias("s")).select("s.history", "s.errors", "s.done").first()
    if not run.done and max(abs(e) for e in run.errors) > tolerance * total:
        warn(f"targets not met after {steps} steps; expected tokens less target, by domain: {list(run.errors)}", stacklevel=2)
    return [list(g) for g in run.history]


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: bool = False) -> DataFrame:
    """``(id, source, n_tokens, p_<domain>..., rate)`` of every row; with ``keep``, instead the rows of ``docs`` with these behind them.

    ``targets`` maps each domain to its share of all tokens. A document's rate
    is how often it is to be read: nonnegative, zero leaves it out. Texts that
    are null or without words have no tokens and the prior's posterior; a
    domain that no document belongs to stays short of its target. Repeated rows
    count each, null ids and sources are kept, other columns play no part (with
    ``keep`` one that is named like a new one gives way to it); an
    empty table gives no rows, and without labelled rows all domains are alike.
    """
    domains = list(targets)
    priors, weights = fit_weights(docs, labelled, domains, id_col=id_col, text_col=text_col)
    members = cut(posteriors(docs, priors, weights, id_col, text_col, source_col))
    tokens = members.agg(F.sum("n_tokens")).first()[0] or 0
    share = sum(targets.values())
    grid = cut(cells(members, len(domains)))
    history = fit_rates(grid, [tokens * t / share for t in targets.values()])
    p = [F.get("p", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(domains)]
    # One row for each point of the grid, which bounds the broadcast.
    rates = F.broadcast(grid.withColumn("rate", _rate(history, len(domains))).select(F.col("cell").alias("q"), "rate"))
    rated = members.join(rates, "q")
    if not keep:
        return rated.select(id_col, source_col, "n_tokens", *p, "rate")
    added = ["n_tokens", *(f"p_{d}" for d in domains), "rate"]
    key = "_" * (1 + max(map(len, docs.columns)))
    once = rated.select(F.col("h").alias(key), "n_tokens", *p, "rate").groupBy(key).agg(*(F.min(c).alias(c) for c in added))
    own = [c for c in docs.columns if c not in added]
    return docs.select(*own, _row_hash(id_col, source_col, text_col).alias(key)).join(once, key).select(*own, *added)


def source_weights(mixed: DataFrame, source_col: str = "source") -> DataFrame:
    """``(source, n_tokens, expected_tokens)``: what each source contributes at the fitted rates."""
    return mixed.groupBy(source_col).agg(F.sum("n_tokens").alias("n_tokens"), F.sum(F.col("n_tokens") * F.col("rate")).alias("expected_tokens"))
