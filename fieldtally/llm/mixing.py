"""Mixing documents to target weights by soft membership (operator 2).

Built from DataFrame functions only. A labelled table (doc_id, domain) teaches
a multinomial classifier over frequent words; every document gets the posterior
of each domain. Nonnegative rates per document are then fitted so that the
expected tokens of each domain, sum of rate * tokens * posterior, match the
targets: projected gradient steps on least squares, each domain's error weighed
by its size. A step needs one number per domain from the cluster and is a fixed
expression over the document's posteriors, so a step is one narrow scan; the
rates are written to the shared folder every ``STEPS_PER_STAGE`` steps.

With errors divided by the domain's present tokens, the step matrix has
eigenvalues between 0 and 1, so full steps converge, slowly where the posteriors of
domains overlap. A fit that ends away from its targets gives the best rates so
far and a ``TargetsMissed`` warning with the greatest error.

The fit uses at most about ``sample`` labelled documents, chosen by a hash of
doc_id, and the ``vocabulary`` most frequent words in them. Evidence is limited
to ``EVIDENCE`` average words, which keeps memberships soft. Rates cover every
document.

Defined results: words stand between white space, in lower case; a null or
empty text has no tokens, the prior as posterior, and the rate its posterior
leads to; rows of one doc_id and text are one result row whose tokens count
once per row (``copies``); null ids are carried; null domains are ignored; a
target for an unknown domain is an error; without any labelled document every
rate is 1; extra columns are ignored.
"""

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldtally.llm.common import staged

SAMPLE_ROWS = 20_000
VOCABULARY = 5_000
MOST_DOMAINS = 64
EVIDENCE = 30.0
SMOOTHING = 0.5
STEPS, STEPS_PER_STAGE, TOLERANCE = 64, 8, 1e-6
HASH_RANGE = 1_000_003


class TargetsMissed(UserWarning):
    """Expected tokens differ from the targets by more than the tolerance."""


def words(text: str = "text") -> Column:
    """The words of a text; none for a null text."""
    cut = F.split(F.lower(F.col(text)), r"\s+")
    return F.coalesce(F.filter(cut, lambda word: word != ""), F.array().cast("array<string>"))


def text_key(text: str = "text") -> Column:
    return F.xxhash64(text)


def domains_of(labelled: DataFrame) -> list[str]:
    found = [row[0] for row in labelled.where("domain is not null").select("domain").distinct()
             .limit(MOST_DOMAINS + 1).collect()]
    if len(found) > MOST_DOMAINS:
        raise ValueError(f"More than {MOST_DOMAINS} domains")
    return sorted(found)


def word_model(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE_ROWS,
               vocabulary: int = VOCABULARY) -> tuple[DataFrame, list[float]]:
    """(word, l0, l1, ...): log probability per domain, at most ``vocabulary``
    rows; and the domains' log priors."""
    usable = (labelled.where("doc_id is not null and domain is not null")
              .groupBy("doc_id").agg(F.min("domain").alias("domain")))
    share = min(1.0, sample / max(1, usable.count()))
    # At most about ``sample`` ids.
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(HASH_RANGE)) < int(share * HASH_RANGE))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "domain", F.explode(words()).alias("word")).where(F.length("word") <= 32)
    counts = (rows.groupBy("word").agg(F.count("*").alias("n"), *[
        F.count_if(F.col("domain") == name).alias(f"c{k}") for k, name in enumerate(domains)])
        .orderBy(F.desc("n"), "word").limit(vocabulary))
    counts = staged(counts, "words")
    sums = counts.agg(F.count("*"), *[F.coalesce(F.sum(f"c{k}"), F.lit(0)) for k in range(len(domains))]).first()
    model = counts.select(F.substring("word", 1, 32).alias("word"), *[
        F.log((F.col(f"c{k}") + SMOOTHING) / (sums[k + 1] + SMOOTHING * max(1, sums[0]))).alias(f"l{k}")
        for k in range(len(domains))])
    sizes = dict(chosen.groupBy("domain").count().collect())
    total = sum(sizes.values()) + len(domains)
    priors = [F.log(F.lit((sizes.get(name, 0) + 1) / total)) for name in domains]
    return model, priors


def memberships(docs: DataFrame, model: DataFrame, priors: list[Column]) -> DataFrame:
    """doc_id, text_key, n_tokens, copies and the posteriors p0, p1, ..."""
    ks = range(len(priors))
    cut = docs.select("doc_id", text_key().alias("text_key"), words().alias("words"))
    each = cut.select("doc_id", "text_key", F.size("words").cast("long").alias("n_tokens"),
                      F.explode_outer("words").alias("word"))
    # The model has at most VOCABULARY rows of short words.
    seen = each.join(F.broadcast(model), "word", "left")
    summed = seen.groupBy("doc_id", "text_key", "n_tokens").agg(
        F.count("*").alias("rows"), F.count("l0").alias("known"),
        *[F.coalesce(F.sum(f"l{k}"), F.lit(0.0)).alias(f"s{k}") for k in ks])
    evidence = F.least(F.lit(EVIDENCE), F.col("known").cast("double"))
    scored = summed.select(
        "doc_id", "text_key", "n_tokens",
        (F.col("rows") / F.greatest("n_tokens", F.lit(1))).cast("long").alias("copies"),
        *[(prior + F.col(f"s{k}") / F.greatest("known", F.lit(1)) * evidence).alias(f"s{k}")
          for k, prior in enumerate(priors)])
    top = F.greatest(*[F.col(f"s{k}") for k in ks]) if len(priors) > 1 else F.col("s0")
    scored = scored.withColumn("top", top)
    raised = scored.select("*", *[F.exp(F.col(f"s{k}") - F.col("top")).alias(f"e{k}") for k in ks])
    total = reduce(lambda a, b: a + b, [F.col(f"e{k}") for k in ks])
    return raised.select("doc_id", "text_key", "n_tokens", "copies",
                         *[(F.col(f"e{k}") / total).alias(f"p{k}") for k in ks])


def totals(members: DataFrame, domains: int, rate: Column) -> list[float]:
    """Expected tokens of each domain."""
    row = members.agg(*[F.coalesce(F.sum(rate * F.col("n_tokens") * F.col("copies") * F.col(f"p{k}")),
                                   F.lit(0.0)) for k in range(domains)]).first()
    return list(row)


def fit_rates(members: DataFrame, targets: list[float], least: float = 0.0, most_steps: int = STEPS,
              tolerance: float = TOLERANCE) -> DataFrame:
    """``members`` with the rate of each document. ``targets`` are tokens per
    domain; no rate falls below ``least``."""
    ks = range(len(targets))
    state = members.withColumn("rate", F.lit(1.0))
    rate, present = F.col("rate"), totals(members, len(targets), F.lit(1.0))
    reached, budget = present, sum(targets)
    for step in range(1, most_steps + 1):
        errors = [a - b for a, b in zip(reached, targets)]
        if max((abs(e) for e in errors), default=0.0) <= tolerance * budget:
            break
        move = reduce(lambda a, b: a + b, [F.col(f"p{k}") * (errors[k] / present[k])
                                           for k in ks if present[k] > 0] or [F.lit(0.0)])
        rate = F.greatest(F.lit(float(least)), rate - move)
        if step % STEPS_PER_STAGE == 0:
            state = staged(state.withColumn("rate", rate), "rates")
            rate = F.col("rate")
        before, reached = reached, totals(state, len(targets), rate)
        if max(abs(a - b) for a, b in zip(before, reached)) <= tolerance * 1e-3 * budget:
            break
    missed = max((abs(a - b) for a, b in zip(reached, targets)), default=0.0)
    if missed > tolerance * budget:
        warnings.warn(f"Expected tokens miss a target by {missed:.6g} of {budget:.6g} tokens",
                      TargetsMissed, stacklevel=2)
    return state.withColumn("rate", rate)


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None,
        flatten: float = 0.0, scale: float = 1.0, least: float = 0.0) -> DataFrame:
    """doc_id, text_key, n_tokens, copies, domain (likeliest), rate.

    ``weights`` are the wanted shares per domain. Without them each domain's
    share is its present share to the power ``flatten``: 0 for equal shares.
    The target total is the present total times ``scale``, raised until no
    domain must shrink if ``least`` is 1 or more."""
    domains = domains_of(labelled)
    unknown = set(weights or ()) - set(domains)
    if unknown:
        raise ValueError(f"Targets for unknown domains: {sorted(unknown)}")
    if not domains:
        return docs.groupBy("doc_id", text_key().alias("text_key")).agg(
            F.first(F.size(words()).cast("long")).alias("n_tokens"), F.count("*").alias("copies")
        ).select("*", F.lit(None).cast("string").alias("domain"), F.lit(1.0).alias("rate"))
    model, priors = word_model(docs, labelled, domains)
    members = staged(memberships(docs, model, priors), "memberships")
    present = totals(members, len(domains), F.lit(1.0))
    shares = ([float(weights.get(name, 0.0)) for name in domains] if weights
              else [have ** flatten if have > 0 else 0.0 for have in present])
    wanted = sum(shares)
    if wanted <= 0:
        rated = members.withColumn("rate", F.lit(1.0))
    else:
        total = scale * sum(present)
        if least >= 1:
            total = max([total, *[have * wanted / share for have, share in zip(present, shares) if share > 0]])
        rated = fit_rates(members, [total * share / wanted for share in shares], least)
    ks = range(len(domains))
    top = F.greatest(*[F.col(f"p{k}") for k in ks]) if len(domains) > 1 else F.col("p0")
    domain = F.coalesce(*[F.when(F.col(f"p{k}") == top, F.lit(name)) for k, name in enumerate(domains)])
    return rated.select("doc_id", "text_key", "n_tokens", "copies", domain.alias("domain"), "rate")


def repeat_documents(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """Each document as often as its rate says: the whole part for certain, one
    more by a hash of the document against the rest."""
    u = F.pmod(F.xxhash64("doc_id", "text_key", F.lit("mix")), F.lit(HASH_RANGE)) / HASH_RANGE
    held, (text, key, doc, times, turn) = docs.columns, free_names(docs, 5)
    rated = rates.select(F.col("doc_id").alias(doc), F.col("text_key").alias(key),
                         F.floor(F.col("rate") + u).cast("int").alias(times))
    keyed = docs.withColumn(text, text_key())
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(text) == F.col(key))
    repeated = keyed.join(rated, same).where(F.col(times) > 0).withColumn(
        turn, F.explode(F.sequence(F.lit(1), times)))
    return repeated.select(*[F.col(f"`{name}`") for name in held])


def free_names(df: DataFrame, count: int) -> list[str]:
    """Column names the frame does not have, in any spelling."""
    prefix = "mix"
    while any(name.lower().startswith(prefix) for name in df.columns):
        prefix += "_"
    return [f"{prefix}{i}" for i in range(count)]
