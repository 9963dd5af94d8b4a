"""Records for the two destinations, built from the store of videos or publications and joined dimensions: customer-relations rows
and search units. Nothing is dropped without a word: what a dimension lacks becomes an entry of `issues`.

Inputs have the columns of `sources.files.VIDEO_FIELDS` or `PUBLICATION_FIELDS`, and data_created, data_updated and tags of a store.
Dimensions: shows (id, name), crm_shows (name, crm_id), guests (name, crm_id), stats (id, n_comments, n_replies, likes, dislikes),
texts (id, hash) and summaries (id, pseudo). URL prefixes, tiers, ignorable names and title rules are parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import people as P
from ..functions import text as T
from . import cdc, enrich, outbox
from .store import tag_add, tag_remove

NONE = "array<string>"
PEOPLE = ("featuring", "interviewer")


def day_or_issue(ms: Column, name: str) -> tuple[Column, Column]:
    """The day of epoch milliseconds, and an issue where there are none (0 or null)."""
    given = F.coalesce(ms, F.lit(0)) != 0
    return F.when(given, T.day_of_ms(ms)), F.when(~given, F.lit(f"no date in {name}"))


def url_of(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


def title_show(title: Column, rules: list[tuple[str, str]]) -> Column:
    """The show of the first rule whose text the title holds; null without one."""
    out = F.lit(None).cast("string")
    for part, show in reversed(rules):
        out = F.when(F.contains(title, F.lit(part)), F.lit(show)).otherwise(out)
    return out


def field_of(kind: str, *sources: Column, tail: bool = False, day: bool = False) -> Column:
    """A target field from one or more source fields: lists of several sources are joined, sorted and distinct, a single one stays as
    it is; of URLs the tail; of milliseconds the day."""
    if kind.startswith("array"):
        return enrich.joined_list(*sources)
    value = sources[0]
    return T.url_tail(value) if tail else T.day_of_ms(value) if day else value


def _issues(*found: Column) -> Column:
    return F.array_compact(F.array(*found))


def with_show(rows: DataFrame, shows: DataFrame, title_rules: list[tuple[str, str]]) -> DataFrame:
    """rows with show_name and __show_issue: the show that the URL names, or else the one that a title rule gives."""
    d = shows.select(F.col("id").cast("string").alias("__sid"), F.col("name").alias("__name"))
    asked = F.nullif(T.url_tail(F.col("show_url")), F.lit(""))
    joined = rows.withColumn("__asked", asked).join(d, F.col("__asked") == F.col("__sid"), "left")
    ruled = title_show(F.col("title"), title_rules)
    issue = F.when(F.col("__asked").isNull() & ruled.isNull(), "no show id").when(F.col("__asked").isNotNull() & F.col("__sid").isNull(), F.concat(F.lit("unknown show id: "), "__asked"))
    return joined.withColumn("show_name", F.when(F.col("__asked").isNull(), ruled).otherwise(F.col("__name"))).withColumn("__show_issue", issue).drop("__asked", "__sid", "__name")


def _people(rows: DataFrame, guests: DataFrame, value: str, ignorable, placeholder) -> DataFrame:
    """(__people, __<column>_found, __<column>_missing) of the people fields as they are written: 'A, B and C'."""
    lists = {c: F.filter(P.split_people(F.col(c)), lambda x: x != "").alias(f"__{c}") for c in PEOPLE}
    # dealt out by id first: what a task gathers is then bounded by its share of the ids, and not by the size of an input split
    own = rows.select("id", *PEOPLE).repartition("id").select("id", *lists.values())
    out = enrich.people_to_fields(own, guests, id_col="id", people_cols=[f"__{c}" for c in PEOPLE], name="name", value=value, placeholder=placeholder, ignorable=ignorable)
    return out.withColumnRenamed("id", "__people")


def needed(videos: DataFrame, target: DataFrame, stats: DataFrame, *, issue_tag: str, upstream_tag: str, comments_tag: str) -> DataFrame:
    """videos with action: add, update, none, or `older` where the target claims to be newer than its source, and the target's tags.
    Updated are records with a newer source, a pending issue, or a change told by a tag of the source or of its comment statistics."""
    t = target.select(F.col("id").alias("__t"), F.col("data_updated").alias("__at"), F.col("tags").alias("__tags"))
    c = stats.where(F.array_contains("tags", comments_tag)).select(F.col("id").alias("__c")) if "tags" in stats.columns else stats.limit(0).select(F.col("id").alias("__c"))
    joined = videos.join(t, F.col("id") == F.col("__t"), "left").join(c, F.col("id") == F.col("__c"), "left")
    told = F.array_contains("__tags", issue_tag) | F.array_contains("tags", upstream_tag) | F.col("__c").isNotNull()
    action = (
        F.when(F.col("__t").isNull(), "add")
        .when(F.col("data_updated") < F.col("__at"), "older")
        .when((F.col("data_updated") > F.col("__at")) | F.coalesce(told, F.lit(False)), "update")
        .otherwise("none")
    )
    return joined.withColumn("action", action).withColumn("target_tags", F.coalesce("__tags", F.array().cast(NONE))).drop("__t", "__at", "__c", "__tags")


def crm_records(
    videos: DataFrame,
    target: DataFrame,
    *,
    shows: DataFrame,
    crm_shows: DataFrame,
    guests: DataFrame,
    stats: DataFrame,
    url_prefix: str,
    tiers: dict[str, list[str]],
    ignorable: tuple[str, ...] = (),
    placeholder: str | None = None,
    title_rules: list[tuple[str, str]] = (),
    issue_tag: str = "issues",
    repush_tag: str = "repush",
    upstream_tag: str = "changed",
    comments_tag: str = "comments_changed",
) -> DataFrame:
    """(id, action, record, issues, tags): a record for each video to add or update; action `delete` for records of the target whose
    video is gone; `older` and `none` without a record.

    A people field with anyone unknown is empty (all or nothing). Fields of comments are null without statistics, is_free is null or
    'FREE'. tags are the target's from now on: repush with every add and update, the issue tag as there are issues or not."""
    rows = needed(videos, target, stats, issue_tag=issue_tag, upstream_tag=upstream_tag, comments_tag=comments_tag)
    work = with_show(rows.where("action in ('add', 'update')"), shows, title_rules)
    s = crm_shows.select(F.col("name").alias("__crm_name"), F.col("crm_id").alias("__crm_show"))
    work = work.join(s, F.col("show_name") == F.col("__crm_name"), "left")
    work = work.join(_people(videos, guests, "crm_id", ignorable, placeholder), F.col("id") == F.col("__people"), "left")
    c = stats.select(F.col("id").alias("__c"), "n_comments", "n_replies", F.col("likes").alias("comment_likes"), F.col("dislikes").alias("comment_dislikes"))
    work = work.join(c, F.col("id") == F.col("__c"), "left").withColumn("__tiers", enrich.tiers(F.col("product"), tiers))
    published, no_published = day_or_issue(F.col("published_on"), "published_on")
    filmed, no_filmed = day_or_issue(F.col("filmed_on"), "filmed_on")
    unknown = lambda c: F.when(F.size(f"__{c}_missing") > 0, F.concat(F.lit(f"{c} not found: "), F.array_join(f"__{c}_missing", ", ")))
    field = lambda c: enrich.all_or_nothing(F.coalesce(f"__{c}_found", F.array().cast(NONE)), F.coalesce(f"__{c}_missing", F.array().cast(NONE)))
    issues = _issues(
        F.col("__show_issue"),
        F.when(F.col("show_name").isNotNull() & F.col("__crm_name").isNull(), F.concat(F.lit("show not found: "), "show_name")),
        unknown("featuring"),
        unknown("interviewer"),
        F.when(F.col("__tiers").isNull(), F.concat(F.lit("unknown product: "), "product")),
        no_published,
        no_filmed,
    )
    record = F.struct(
        F.col("title"),
        F.array(F.coalesce("__crm_show", F.lit(""))).alias("show"),
        field("featuring").alias("featuring"),
        field("interviewer").alias("interviewers"),
        F.col("description"),
        enrich.joined_list(F.col("topics"), F.col("tag_names"), F.col("assets")).alias("topics"),
        F.col("likes"),
        F.col("dislikes"),
        F.col("product"),
        published.alias("published_on"),
        filmed.alias("filmed_on"),
        F.col("id").alias("website_id"),
        F.col("data_updated").alias("last_change"),
        url_of(url_prefix, F.col("id")).alias("link"),
        F.col("__tiers").alias("available_to"),
        F.col("n_comments"),
        F.col("n_replies"),
        F.col("comment_likes"),
        F.col("comment_dislikes"),
        F.when(F.col("is_free"), "FREE").alias("is_free"),
    )
    pushed = tag_add(F.col("target_tags"), repush_tag)
    tags = F.when(F.size("issues") > 0, tag_add(pushed, issue_tag)).otherwise(tag_remove(pushed, issue_tag))
    built = work.withColumn("issues", issues).select("id", "action", record.alias("record"), "issues", tags.alias("tags"))
    empty = F.lit(None).cast(built.schema["record"].dataType)
    idle = rows.where("action in ('none', 'older')").select("id", "action", empty.alias("record"), F.array().cast(NONE).alias("issues"), F.col("target_tags").alias("tags"))
    gone = target.select("id", "tags").join(videos.select("id"), "id", "left_anti")
    gone = gone.select("id", F.lit("delete").alias("action"), empty.alias("record"), F.array().cast(NONE).alias("issues"), "tags")
    return built.unionByName(idle).unionByName(gone)


def issue_table(records: DataFrame) -> DataFrame:
    """(title, id, n, issues): one row a record with issues, for a report."""
    return records.where(F.size("issues") > 0).select(F.col("record.title").alias("title"), "id", F.size("issues").alias("n"), F.array_join("issues", "; ").alias("issues"))


def consumed_tags(rows: DataFrame, records: DataFrame, tag: str) -> DataFrame:
    """rows (id, ..., tags) without a tag whose change the records took in."""
    done = records.where("action = 'update'").select(F.col("id").alias("__d"))
    joined = rows.join(done, F.col("id") == F.col("__d"), "left")
    return joined.withColumn("tags", F.when(F.col("__d").isNotNull(), tag_remove(F.col("tags"), tag)).otherwise(F.col("tags"))).select(rows.columns)


# ---- search units ----


def _with_texts(rows: DataFrame, texts: DataFrame, summaries: DataFrame) -> DataFrame:
    """rows with the hashes of the text and of its summary, null where there is none: the texts themselves follow on delivery."""
    t = texts.select(F.col("id").alias("__t"), F.col("hash").alias("transcript"))
    p = summaries.where("pseudo is not null and pseudo <> ''").select(F.col("id").alias("__p"), F.sha2(F.col("pseudo").cast("binary"), 256).alias("__pseudo"))
    out = rows.join(t, F.col("id") == F.col("__t"), "left").join(p, F.col("id") == F.col("__p"), "left")
    return out.withColumn("pseudo_transcript", F.when(F.col("__t").isNotNull(), F.col("__pseudo"))).drop("__t", "__p", "__pseudo")


VIDEO_UNIT = ("type", "title", "description", "thumbnail", "featuring", "interviewer", "tags", "likes", "dislikes", "show", "product", "url", "duration", "published_on", "published_day", "tiers", "n_comments", "transcript", "pseudo_transcript")
PUBLICATION_UNIT = ("type", "title", "description", "thumbnail", "pages", "tags", "likes", "dislikes", "product", "url", "published_on", "published_day", "tiers", "transcript", "pseudo_transcript")
#: Which fields may go to an index: videos with summaries, videos with whole texts, publications with summaries.
INDEXES = {
    "videos": [f for f in VIDEO_UNIT if f != "transcript"],
    "videos_full": [f for f in VIDEO_UNIT if f != "pseudo_transcript"],
    "publications": [f for f in PUBLICATION_UNIT if f != "transcript"],
}
#: How an index searches. Attributes are searched in this order; replicas are further orders of the same units.
SETTINGS = {
    "searchable": ["pseudo_transcript", "description", "title", "featuring", "interviewer", "tags"],
    "typo_tolerance": False,
    "min_proximity": 2,
    "facets": ["featuring", "interviewer", "show", "published_on", "tiers"],
    "retrievable": ["id", "thumbnail", "title", "description", "featuring", "interviewer", "tiers", "show", "url", "duration", "published_on"],
    "unretrievable": ["type", "tags", "likes", "dislikes", "product", "published_day", "n_comments", "pseudo_transcript"],
    "ranking": ["typo", "geo", "words", "filters", "proximity", "attribute", "exact"],
    "custom_ranking": [("published_on", False)],
}
#: Replica -> (field, whether ascending), which goes before the ranking.
REPLICAS = {"date_descending": ("published_on", False), "date_ascending": ("published_on", True), "likes_descending": ("likes", False), "suggestions": ("published_on", False)}


def index_settings(name: str | None = None) -> dict:
    """The settings of the main index, or of a replica: the same, with the replica's order before the ranking."""
    if name is None:
        return dict(SETTINGS)
    field, up = REPLICAS[name]
    return {**{k: v for k, v in SETTINGS.items() if k != "custom_ranking"}, "ranking": [("asc" if up else "desc", field), *SETTINGS["ranking"]]}


def video_units(videos: DataFrame, *, shows: DataFrame, guests: DataFrame, stats: DataFrame, texts: DataFrame, summaries: DataFrame, url_prefix: str, tiers: dict[str, list[str]], ignorable: tuple[str, ...] = (), placeholder: str | None = None) -> DataFrame:
    """(id, VIDEO_UNIT fields, hash, issues): the current values of each video's search unit. People that the guests lack are left
    out; tags are the union of tags, assets and topics; fields that the video has no data for are null."""
    rows = with_show(videos, shows, [])
    rows = rows.join(_people(videos, guests, "name", ignorable, placeholder), F.col("id") == F.col("__people"), "left")
    rows = rows.join(stats.select(F.col("id").alias("__c"), "n_comments"), F.col("id") == F.col("__c"), "left")
    rows = _with_texts(rows, texts, summaries).withColumn("__tiers", enrich.tiers(F.col("product"), tiers))
    day, no_day = day_or_issue(F.col("published_on"), "published_on")
    issues = _issues(F.when(F.col("__show_issue") != "no show id", F.col("__show_issue")), F.when(F.col("__tiers").isNull(), F.concat(F.lit("unknown product: "), "product")), no_day)
    out = rows.select(
        "id", "type", "title", "description", "thumbnail",
        F.coalesce("__featuring_found", F.array().cast(NONE)).alias("featuring"), F.coalesce("__interviewer_found", F.array().cast(NONE)).alias("interviewer"),
        enrich.joined_list(F.col("tag_names"), F.col("assets"), F.col("topics")).alias("tags"), "likes", "dislikes", F.coalesce("show_name", F.lit("")).alias("show"), "product",
        url_of(url_prefix, F.col("id")).alias("url"), "duration", "published_on", day.alias("published_day"), F.coalesce("__tiers", F.array().cast(NONE)).alias("tiers"), "n_comments", "transcript", "pseudo_transcript", issues.alias("issues"),
    )
    return out.withColumn("hash", cdc.record_hash(["id", *VIDEO_UNIT]))


def publication_units(publications: DataFrame, *, texts: DataFrame, summaries: DataFrame, url_prefix: str, tiers: dict[str, list[str]]) -> DataFrame:
    """(id, PUBLICATION_UNIT fields, hash, issues). Tags are assets and then topics, with all repetitions."""
    rows = _with_texts(publications, texts, summaries).withColumn("__tiers", enrich.tiers(F.col("product"), tiers))
    day, no_day = day_or_issue(F.col("published_on"), "published_on")
    issues = _issues(F.when(F.col("__tiers").isNull(), F.concat(F.lit("unknown product: "), "product")), no_day)
    out = rows.select(
        "id", "type", "title", F.col("summary").alias("description"), "thumbnail", "pages", enrich.joined_list(F.col("assets"), F.col("topics"), distinct=False).alias("tags"), "likes", "dislikes", "product",
        url_of(url_prefix, F.col("id")).alias("url"), "published_on", day.alias("published_day"), F.coalesce("__tiers", F.array().cast(NONE)).alias("tiers"), "transcript", "pseudo_transcript", issues.alias("issues"),
    )
    return out.withColumn("hash", cdc.record_hash(["id", *PUBLICATION_UNIT]))


def unit_plan(units: DataFrame, fresh: DataFrame, *, delete_tag: str = "delete") -> DataFrame:
    """(id, op, pushed, current, hash, tags): the unit store after an update. units: (id, pushed, current, hash, tags); fresh: what
    video_units or publication_units gives. add: new; update: another hash and another value; none; gone: no longer in fresh, only
    tagged, as the index still has it."""
    fields = [c for c in fresh.columns if c not in ("id", "hash", "issues")]
    after = outbox.update(units.select("id", "pushed", "current"), fresh.select("id", *fields), "id")
    u = units.select(F.col("id").alias("__u"), F.col("current").alias("__before"), F.col("hash").alias("__hash"), "tags")
    f = fresh.select(F.col("id").alias("__f"), F.col("hash").alias("__new"))
    rows = after.join(u, F.col("id") == F.col("__u"), "left").join(f, F.col("id") == F.col("__f"), "left")
    kinds = [(x.name, x.dataType.simpleString()) for x in after.schema["current"].dataType.fields]
    differs = F.lit(False)
    for c, t in kinds:
        differs = differs | ~outbox.same(t, F.col("__before")[c], F.col("current")[c])
    op = F.when(F.col("__u").isNull(), "add").when(F.col("__f").isNull(), "gone").when((F.col("__hash") != F.col("__new")) & differs, "update").otherwise("none")
    tags = F.coalesce("tags", F.array().cast(NONE))
    return rows.withColumn("op", op).select("id", "op", "pushed", "current", F.coalesce("__new", "__hash").alias("hash"), F.when(F.col("op") == "gone", tag_add(tags, delete_tag)).otherwise(tags).alias("tags"))
