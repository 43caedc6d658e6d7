"""Pages of cards against the state of the last run: what is kept, rejected, repeated or known, and where a flow stops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terralume.functions.instants import parse_instant
from terralume.functions.scalars import blank, flow_from_url
from terralume.operators.latest import islands, stop_position, top_per_key
from terralume.operators.quality import reject_reason


def card_state(previous: DataFrame, ordinal: str) -> tuple[DataFrame, DataFrame]:
    """(``listing_url, previous_price`` of the last row of each URL; ``flow, oldest, newest`` posting of each flow) of stored cards.

    The flow is the business type if it is one of the two, else what the URL tells; rows without URL are passed over, and
    rows without a readable posting or flow don't take part in the second.
    """
    known = previous.where(~blank(F.col("listing_url"))).withColumn("listing_url", F.trim("listing_url"))
    prices = known.groupBy("listing_url").agg(F.max_by(F.struct("price_brl"), ordinal).alias("last")).select("listing_url", F.col("last.price_brl").alias("previous_price"))
    business = F.lower(F.trim("business_type"))
    flow = F.when(business.isin("rent", "sale"), business).otherwise(flow_from_url(F.col("listing_url")))
    dated = known.select(flow.alias("flow"), parse_instant(F.col("listing_posted_at")).alias("at")).where(F.col("flow").isNotNull() & F.col("at").isNotNull())
    return prices, dated.groupBy("flow").agg(F.min("at").alias("oldest"), F.max("at").alias("newest"))


def card_reasons() -> dict[str, Column]:
    """Why a card is rejected, in the order in which it is asked."""
    posted, raw = F.col("listing_posted_at"), F.col("raw_card_date_text")
    unread = parse_instant(posted).isNull()
    return {
        "missing_listing_url": blank(F.col("listing_url")),
        "missing_price": F.col("price_brl").isNull(),
        "unexpected_invalid_record": unread & posted.isNotNull() & (posted != ""),
        "unparsed_card_date_text": unread & ~blank(raw),
        "missing_card_date_text": unread,
    }


def judge_cards(cards: DataFrame, prices: DataFrame, flows: DataFrame, page: str = "page", position: str = "position") -> DataFrame:
    """``verdict`` of each card (``invalid``, ``duplicate``, ``same_price`` or ``kept``), ``invalid_reason``, and ``old``.

    ``cards`` has ``flow``, the page and position, ``listing_url, price_brl, listing_posted_at, raw_card_date_text``. A valid card is
    ``old`` if it was posted at or before the newest one of its flow in the last run. The first valid card of a URL in a flow
    counts, later ones are duplicates; one whose price is the known one is dropped as ``same_price``. Cards of one (flow, URL)
    meet in a window; no window holds a flow.
    """
    judged = cards.withColumn("invalid_reason", reject_reason(card_reasons())).withColumn("listing_url", F.trim("listing_url"))
    valid = judged.where(F.col("invalid_reason").isNull()).withColumn("_n", F.row_number().over(Window.partitionBy("flow", "listing_url").orderBy(page, position)))
    known = valid.join(prices.withColumn("_known", F.lit(True)), "listing_url", "left").join(flows.select("flow", "newest"), "flow", "left")
    old = F.coalesce(parse_instant(F.col("listing_posted_at")) <= F.col("newest"), F.lit(False))
    verdict = F.when(F.col("_n") > 1, "duplicate").when(F.coalesce(F.col("_known") & (F.col("previous_price") == F.col("price_brl")), F.lit(False)), "same_price").otherwise("kept")
    good = known.withColumns({"verdict": verdict, "old": old}).select(*judged.columns, "verdict", "old")
    bad = judged.where(F.col("invalid_reason").isNotNull()).withColumns({"verdict": F.lit("invalid"), "old": F.lit(False)})
    return good.unionByName(bad)


def page_counts(judged: DataFrame, page: str = "page") -> DataFrame:
    """A row for each page: cards seen, kept, repeated, of known price, rejected, kept though old, and whether it is ``sterile``:
    all its valid cards are old and none was kept."""
    v = F.col("verdict")
    counted = judged.groupBy("flow", page).agg(F.count("*").alias("items_seen"), F.count_if(v == "kept").alias("items_kept"), F.count_if(v == "duplicate").alias("duplicates_in_run"), F.count_if(v == "same_price").alias("same_price_ignored"), F.count_if(v == "invalid").alias("invalid_records"), F.count_if(F.col("old")).alias("_old"), F.count_if(~F.col("old") & (v != "invalid")).alias("_newer"), F.count_if(F.col("old") & (v == "kept")).alias("useful_overlap"))
    inside = (F.col("_old") > 0) & (F.col("_newer") == 0)
    return counted.withColumns({"fully_in_overlap": inside, "sterile": inside & (F.col("useful_overlap") == 0)}).drop("_old", "_newer")


def run_cards(cards: DataFrame, prices: DataFrame, flows: DataFrame, sterile_pages: int = 3, page: str = "page", position: str = "position") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept cards, rejected cards with their reason, page counts) of a run that stops a flow after ``sterile_pages`` sterile pages on end.

    Pages behind the stop are not part of the run. An empty run gives empty tables.
    """
    judged = judge_cards(cards, prices, flows, page, position)
    pages = page_counts(judged, page)
    stops = stop_position(islands(pages, "flow", page, F.col("sterile")), "flow", sterile_pages)
    within = lambda df: df.join(stops, "flow", "left").where(F.col("stop_at").isNull() | (F.col(page) <= F.col("stop_at"))).drop("stop_at")
    taken = within(judged)
    business = F.when(F.col("flow") == "rent", "rent").otherwise("sale")
    kept = taken.where(F.col("verdict") == "kept").select("listing_url", business.alias("business_type"), "price_brl", "listing_posted_at", page, position)
    rejected = taken.where(F.col("verdict") == "invalid").select("flow", "invalid_reason", F.when(~blank(F.col("listing_url")), F.col("listing_url")).alias("listing_url"), "price_brl", "listing_posted_at", "raw_card_date_text", *[c for c in ("title",) if c in taken.columns])
    return kept, rejected, within(pages)


def posted_order(posted: str = "listing_posted_at") -> Column:
    """Newest first, what can't be read last."""
    return parse_instant(F.col(posted)).desc_nulls_last()


def first_of_urls(kept: DataFrame, page: str = "page", position: str = "position") -> DataFrame:
    """One row for each URL over all flows: the newest posting, earlier cards first among equals."""
    return top_per_key(kept, ["listing_url"], [posted_order(), F.col(page).asc(), F.col(position).asc(), F.col("business_type").asc()])
