"""Composed jobs: DataFrames in, tables and a summary out."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import address
from ..operators import contracts, ledger, merge, tables


def ingest_meetings(meetings: DataFrame, seed: DataFrame, videos: DataFrame, feed: DataFrame | None, corrections: DataFrame, tie: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Meetings in effect, videos, one summary row.

    Without a feed neither videos nor gaps change; of feed rows of equal
    ``load_seq`` the one of greatest ``tie`` counts.  Overrides are applied to
    the merged table each time, so another seed never loses them.
    """
    merged = merge.merge(meetings, seed, "meeting_id", "meeting_id")
    if feed is not None:
        videos = merge.merge(videos, feed, "video_id", "load_seq", tie)
        merged = merge.fill_video_urls(merged, videos)
    # An override of an unknown meeting meets no row; the job that writes refuses it.
    result = ledger.effective(merged, corrections)
    summary = result.agg(F.count("*").alias("meetings"), F.count("video_url").alias("meetings_with_video"), F.max("meeting_date").alias("latest"))
    return result, videos, summary


def ingest_all(tables: dict[str, DataFrame], seed: dict[str, DataFrame], feed: DataFrame | None, corrections: DataFrame, tie: str | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The four tables after a seed, a feed and corrections, and one summary row.

    ``tables`` and ``seed`` hold meetings, controversies and sources, ``tables``
    videos as well.  Without a feed the number of meetings with a video is that
    of the seed.
    """
    meetings, videos, _ = ingest_meetings(tables["meetings"], seed["meetings"], tables["videos"], feed, corrections, tie)
    out = {"meetings": meetings, "videos": videos}
    for name, key in (("controversies", "controversy_id"), ("sources", "source_id")):
        out[name] = merge.merge(tables[name], seed[name], key, key)
    count = lambda df, name: df.agg(F.count("*").alias(name))
    summary = count(seed["meetings"], "seeded_meetings")
    for name in ("controversies", "sources"):
        summary = summary.crossJoin(F.broadcast(count(seed[name], f"seeded_{name}")))
    with_video = meetings.agg(F.count("video_url").alias("meetings_with_video")) if feed is not None else summary.select(F.col("seeded_meetings").alias("meetings_with_video"))
    fed = count(feed, "videos_upserted") if feed is not None else summary.select(F.lit(0).cast("long").alias("videos_upserted"))
    applied = count(corrections.join(meetings.select("meeting_id"), "meeting_id", "left_semi"), "corrections_applied")
    # One row each.
    return out, summary.crossJoin(F.broadcast(fed)).crossJoin(F.broadcast(with_video)).crossJoin(F.broadcast(applied))


SEEDED = {"seb.meetings": "meeting_id", "seb.controversies": "controversy_id", "seb.sources": "source_id"}
CORRECTIONS = "seb.meeting_corrections"
LOGGED = "correction_id string, meeting_id long, target_column string, original_value string, corrected_value string, reason string, evidence_url string, corrected_by string, corrected_at timestamp, applied_at timestamp, load_seq string"


def apply_corrections(change: tables.Change, batch: DataFrame, at: datetime) -> dict[str, int]:
    """Log the overrides that aren't logged yet, each with the value it replaces; {logged, applied, skipped}.

    Rules are checked and rows counted in the pass that writes.  A row that
    breaks a rule raises, an id that occurs twice in the batch does, and so does
    a new override of an unknown meeting; logged ones are skipped unseen.
    Overrides of a later run follow all those before.

    An id is looked for among its meeting's first, so rows are sent once; should
    one turn out to be of two meetings, all are looked up by id instead.
    """
    empty = change.store.spark.createDataFrame([], LOGGED)
    change.create(CORRECTIONS, empty, "correction_id")
    run = 0 if change.base is None else change.base + 1
    seq = F.col("load_seq") if dict(batch.dtypes)["load_seq"] == "string" else F.lpad(F.col("load_seq").cast("string"), 20, "0")
    broken = F.size(contracts.violations(contracts.correction_rules())) > 0
    rows = batch.withColumns({"_broken": broken, "load_seq": F.concat(F.lit(f"{run:012d}|"), seq)})
    log, meetings, before = change.read(CORRECTIONS), change.read("seb.meetings"), change.manifest[CORRECTIONS]

    def write(marked: DataFrame, dealt: bool) -> dict[str, int]:
        whole = marked.withColumns({
            "corrected_at": F.coalesce("corrected_at", F.lit(at).cast("timestamp")),
            "applied_at": F.lit(at).cast("timestamp"),
            "evidence_url": F.col("evidence_url") if "evidence_url" in batch.columns else F.lit(None).cast("string"),
        })
        good = ~F.col("known") & ~F.col("lost") & ~F.col("_broken") & (F.col("_times") == 1)
        return change.append(CORRECTIONS, whole, "correction_id", good, ledger.apply_counts() | {"broken": F.count_if("_broken"), "twice": F.count_if(F.col("_times") > 1)}, dealt)

    counts = write(ledger.applied_within(rows, log, meetings), True)
    if counts["broken"]:
        contracts.split_valid(batch, contracts.correction_rules(), strict=True)
        raise contracts.ContractError("a correction breaks a rule")
    if counts["twice"] or counts["lost"] or (counts["logged"] and contracts.any_repeated(change.read(CORRECTIONS), "correction_id")):
        # What was written goes with the next ``clear``, as no manifest names it.
        change.manifest[CORRECTIONS] = before
        twice = contracts.repeated(batch, "correction_id").limit(1).collect()
        if twice:
            raise contracts.ContractError(f"correction {twice[0].correction_id!r} occurs {twice[0].n} times in the batch")
        marked = ledger.applied(rows.withColumn("_times", F.lit(1)), log, meetings)
        counts = write(marked, False)
        if counts["lost"]:
            first = marked.filter("lost").orderBy("load_seq").first()
            raise contracts.ContractError(f"correction {first.correction_id!r} targets meeting {first.meeting_id}, which seb.meetings lacks")
    return {k: counts[k] for k in ("logged", "applied", "skipped")}


def ingest(store: tables.Store, seed: dict[str, DataFrame], feed: DataFrame | None, corrections: DataFrame | None, at: datetime, source: str = "workbook_v0", tie: str | None = None) -> dict:
    """Seed, feed, gap fill and corrections as one change of the store; what landed.

    The set with all five tables counts at the end or not at all.  Without a
    feed neither videos nor gaps change, and as many meetings count as having a
    video as were seeded.  Meetings stay as they were seeded: those in effect
    are ``meetings_in_effect``.
    """
    when = F.lit(at).cast("timestamp")
    rows = {name: seed[name] if name == "seb.sources" else seed[name].withColumn("loaded_at", when) for name in SEEDED}
    rows["seb.meetings"] = rows["seb.meetings"].withColumn("source", F.lit(source))
    with store.change() as change:
        change.create("seb.meetings", rows["seb.meetings"], "meeting_id")
        incoming = rows["seb.meetings"].withColumn("_seed", F.lit(True))
        if feed is not None:
            change.upsert("seb.videos", feed.withColumn("loaded_at", when), "video_id", "load_seq", tie, unread=("loaded_at",))
            open_ = change.read("seb.meetings").filter("video_url IS NULL").join(incoming.select("meeting_id"), "meeting_id", "left_anti")
            # Seeded rows, and others whose gap the videos fill.
            incoming = merge.fill_video_urls(incoming.unionByName(open_.withColumn("_seed", F.lit(False))), change.read("seb.videos")).filter("_seed OR video_url IS NOT NULL")
        rows["seb.meetings"] = incoming
        for name, key in SEEDED.items():
            change.upsert(name, rows[name], key, key, unread=("loaded_at",), counted=F.col("_seed") if name == "seb.meetings" else None)
        seeded = {name.removeprefix("seb."): change.upserted[name] for name in SEEDED}
        summary = {"seed": seeded, "videos_upserted": 0, "meetings_with_video_url": seeded["meetings"]}
        if feed is not None:
            change.require_references("seb.videos", "meeting_id", "seb.meetings", "meeting_id")
            summary["videos_upserted"] = change.upserted["seb.videos"]
            summary["meetings_with_video_url"] = change.read("seb.meetings").filter("video_url IS NOT NULL").count()
        summary["corrections"] = {"logged": 0, "applied": 0, "skipped": 0}
        if corrections is not None:
            summary["corrections"] = apply_corrections(change, corrections, at)
            change.compact(CORRECTIONS)
    return summary


def meetings_in_effect(store: tables.Store) -> DataFrame:
    """The meetings of the present set with all their overrides."""
    meetings = store.read("seb.meetings")
    return ledger.effective(meetings, store.read(CORRECTIONS)) if CORRECTIONS in store.tables() else meetings


def apply_suppressions(batch: DataFrame, log: DataFrame, voters: DataFrame, require_voter: bool = True) -> tuple[DataFrame, DataFrame]:
    """The ledger with a checked batch appended, and {logged, skipped}."""
    contracts.split_valid(batch, contracts.suppression_rules(), strict=True)
    new = ledger.unlogged(batch, log, "suppression_id")
    if contracts.repeated(batch, "suppression_id").limit(1).count():
        raise contracts.ContractError("an id occurs twice in the batch")
    if ledger.unresolved(new, log).limit(1).count():
        raise contracts.ContractError("a row supersedes an unknown id")
    if require_voter and ledger.missing(new, "voter_id", voters, "voter_id").limit(1).count():
        raise contracts.ContractError("a row names an unknown voter")
    return ledger.append(batch, log, "suppression_id")


SUPPRESSIONS = "voter.suppressions"
ASKED = "suppression_id string, voter_id long, action string, reason string, requested_by string, supersedes string, requested_at timestamp, applied_at timestamp"


def log_suppressions(change: tables.Change, batch: DataFrame, at: datetime, voters: DataFrame | None = None, once: bool = True) -> dict[str, int]:
    """Log the requests that aren't logged yet; {logged, skipped} of the pass that writes.

    Of the ledger only the buckets of the ids in the batch are read.  A broken
    rule, a row that supersedes an id neither in the batch nor logged, one for
    an unknown voter (if ``voters`` is given) and, with ``once``, an id that
    occurs twice in the batch refuse the whole batch.
    """
    contracts.split_valid(batch, contracts.suppression_rules(), strict=True)
    twice = contracts.repeated(batch, "suppression_id").limit(1).collect() if once else []
    if twice:
        raise contracts.ContractError(f"suppression {twice[0].suppression_id!r} occurs {twice[0].n} times in the batch")
    rows = batch if once else batch.dropDuplicates(["suppression_id"])
    change.create(SUPPRESSIONS, change.store.spark.createDataFrame([], ASKED), "suppression_id")
    rows = rows.withColumns({"requested_at": F.coalesce("requested_at", F.lit(at).cast("timestamp")), "applied_at": F.lit(at).cast("timestamp")})
    named = rows.filter("supersedes IS NOT NULL").select(F.col("supersedes").alias("suppression_id"))
    logged = change.matching(SUPPRESSIONS, named.unionByName(rows.select("suppression_id")), "suppression_id").select("suppression_id")
    lost = ledger.unresolved(rows, logged).limit(1).collect()
    if lost:
        raise contracts.ContractError(f"suppression {lost[0].suppression_id!r} supersedes {lost[0].supersedes!r}, which is unknown")
    marked = rows.join(logged.withColumn("known", F.lit(True)), "suppression_id", "left").withColumn("known", F.coalesce("known", F.lit(False)))
    if voters is not None:
        # Logged requests are checked too, as they were when they came.
        stray = ledger.missing(rows, "voter_id", voters, "voter_id").limit(1).collect()
        if stray:
            raise contracts.ContractError(f"suppression {stray[0].suppression_id!r} targets voter {stray[0].voter_id}, who is unknown")
    counts = change.append(SUPPRESSIONS, marked, "suppression_id", ~F.col("known"), {"logged": F.count_if(~F.col("known")), "skipped": F.count_if("known")})
    change.compact(SUPPRESSIONS)
    return counts


def load_registry(voters: DataFrame, good: DataFrame, source: str, loaded_at) -> DataFrame:
    rows = good.withColumns({"source": F.lit(source), "loaded_at": F.lit(loaded_at).cast("timestamp")})
    return merge.merge(voters, rows.select(voters.columns), "voter_id", "voter_id")


def standard_addresses(people: DataFrame) -> DataFrame:
    """voter_id, line, the parts of the line again, and whether a house lacks its street."""
    c = F.col
    line = address.compose(c("house_number"), c("street_name"), c("street_suffix"), c("apartment"), c("city"), c("zip5"))
    lines = people.select("voter_id", line.alias("line"), address.house_without_street(c("house_number"), c("street_name")).alias("bad"))
    return address.split(lines, "line").select("voter_id", "line", "bad", "parts.*")
