"""The whole run: pull from the site, bring the stores up to date, derive texts' artefacts, deliver to both destinations and drop old
versions, in seventeen steps at three levels of thoroughness (`control.LEVELS`). Every step is a method, so a run can be cut short or
a step be run alone; what a step needs it reads from the stores, so a failed step holds up only what the stores then lack. Steps
are a graph: videos and publications, comments and texts, dimensions and artefacts go side by side."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import people as P
from ..operators import checks, delivery, enrich, records, texts
from ..operators.store import Store
from ..operators.versions import Versions
from ..sources import files, pull
from . import scratch
from .control import Control, Level, may_delete, run_graph

MISSING = "transcript_missing"


@dataclass
class Setting:
    """What a run is told: where things are, what the products are, and how names and URLs are formed."""

    folder: str
    products: list[str]
    publication_products: list[str]
    tiers: dict[str, list[str]]
    video_url: str = "video/"
    publication_url: str = "publication/"
    ignorable: tuple[str, ...] = ()
    placeholder: str | None = None
    title_rules: list[tuple[str, str]] = field(default_factory=list)
    unwanted_terms: list[str] = field(default_factory=list)
    most_video_deletions: int = 10
    most_publication_deletions: int = 5
    new_for_days: int = 14
    pause: float = 0.2
    buckets: int = 16
    keep_versions: int = 48
    at_once: int = 4


class Run:
    """One run over a folder of stores. crm and indexes (name -> destination) are where records go."""

    def __init__(self, spark: SparkSession, setting: Setting, site: pull.Site, crm, indexes: dict[str, object], control: Control, *, now: Callable[[], int], dry_run: bool = False):
        self.spark, self.setting, self.site, self.crm, self.indexes, self.control, self.dry_run = spark, setting, site, crm, indexes, control, dry_run
        self.now = now()  # one time for the whole run
        at = lambda name: f"{setting.folder.rstrip('/')}/{name}"
        fields = lambda f: [c for c in f if c != "id"]
        self.pulls = pull.Pulls(spark, at("pulls"), site)
        self.paging = Versions(spark, at("paging"), 1)
        self.videos = Store(spark, at("videos"), "id", fields(files.VIDEO_FIELDS), created="published_on", buckets=setting.buckets)
        self.publications = Store(spark, at("publications"), "id", fields(files.PUBLICATION_FIELDS), created="published_on", buckets=setting.buckets)
        self.stats = Store(spark, at("comment-stats"), "id", ["n_comments", "n_replies", "likes", "dislikes"], buckets=setting.buckets)
        self.transcripts = texts.TextStore(spark, at("transcripts"), "id", "string", buckets=setting.buckets)
        self.full_texts = texts.TextStore(spark, at("full-texts"), "id", "string", buckets=setting.buckets)
        self.crm_local = Versions(spark, at("crm-records"), setting.buckets)
        self.units = {name: Versions(spark, at(f"units-{name}"), setting.buckets) for name in records.INDEXES}
        dim = lambda table, columns, key: pull.Snapshots(spark, at("crm"), site, table, columns, key)
        self.guests = dim("guests", ["name", "id", "subjects"], "name")
        self.crm_shows = dim("shows", ["name", "id", "site_name"], "site_name")
        self.crm_videos = dim("videos", ["id", "website_id"], "website_id")
        self.report: dict[str, object] = {}
        self.whole = {"videos": False, "publications": False}

    # ---- 1-4: videos from the site ----

    def login(self, level: Level) -> None:
        self.site.login()

    def probe(self, level: Level) -> dict:
        """Page sizes and last pages of the products (all levels but the first, and where there are none yet)."""
        if not level.deletions and self.paging.has("paging"):
            return {}
        fresh, errors = pull.probe_paging(self.spark, self.site, "videos", self.setting.products)
        old = self.paging.read("paging") if self.paging.has("paging") else fresh.limit(0)
        self.paging.commit({"paging": (pull.updated_paging(old, fresh), "product", None)})
        return errors

    def pull_videos(self, level: Level) -> bool:
        """Shows and videos; a failed pull stops the job, as nothing behind it can be trusted."""
        paging = self.paging.read("paging")
        ok = self.pulls.pull("shows", None, self.setting.products) and self.pulls.pull("videos", paging, self.setting.products, most=level.pull_most)
        if not ok:
            self.control.set("jobs", False)
            return False
        ids = checks.duplicate_ids(self.pulls.outer_ids("videos", "video_id"), "id", "inner").first().ok
        full = all(r.full for r in checks.full_pull(self.pulls.files("videos"), paging.where(F.col("product").isin(*self.setting.products))).collect())  # a row a product
        self.whole["videos"] = may_delete(level, pull_ok=ok, ids_ok=ids, full=full)
        return True

    def sync_videos(self, level: Level) -> dict:
        rows = self.pulls.read("videos", files.VIDEO, files.VIDEO_FIELDS)
        return self.videos.sync(rows, now=self.now, full=self.whole["videos"], most_deletions=self.setting.most_video_deletions, dry_run=self.dry_run)

    # ---- 5-7: publications ----

    def pull_publications(self, level: Level) -> bool:
        if not level.deletions:
            return False
        ok = self.pulls.pull("publications", None, self.setting.publication_products)
        ids = ok and checks.duplicate_ids(self.pulls.outer_ids("publications", "issue_id"), "id", "inner").first().ok
        self.whole["publications"] = may_delete(level, pull_ok=ok, ids_ok=ids, full=ok and pull.whole_publications(self.pulls.files("publications"), self.setting.publication_products))
        return ok

    def sync_publications(self, level: Level) -> dict:
        if not level.deletions or not self.pulls.versions.has("publications"):
            return {}
        rows = self.pulls.read("publications", files.PUBLICATION, files.PUBLICATION_FIELDS)
        return self.publications.sync(rows, now=self.now, full=self.whole["publications"], most_deletions=self.setting.most_publication_deletions, dry_run=self.dry_run)

    # ---- 8-13: comments, texts and artefacts ----

    def _page(self) -> int:
        return pull.paging_of(self.paging.read("paging"), self.setting.products[0], "base_multiple") or 24

    def _newest(self, store: Store, pages: int | None) -> DataFrame:
        rows = store.read()
        return rows if pages is None else rows.orderBy(F.desc("data_created"), "id").limit(pages * self._page())

    def comments(self, level: Level) -> dict:
        ids = self._newest(self.videos, level.comment_pages).select("id")
        got = scratch.written(pull.fetched_comments(ids, "id", self.site), "comments").where("error is null")
        stats = enrich.comment_stats(got, "id")
        old = self.stats.read() if self.stats.version() else None
        counts = self.stats.sync(stats, now=self.now, full=False, dry_run=self.dry_run)
        if not self.dry_run and set(counts) & {"add", "update"}:
            same = old.select("id", "hash").join(self.stats.read().select("id", "hash"), ["id", "hash"]) if old is not None else self.stats.read().select("id").limit(0)
            changed = self.stats.read().select("id").join(same.select("id"), "id", "left_anti")
            self.stats.add_tag("comments_changed", changed)
        return counts

    def _texts(self, store: Store, target: texts.TextStore, kind: str, rows: DataFrame, *, retry: bool, missing: str | None) -> dict:
        have = target.read()
        wanted = checks.retry_candidates(rows.select("id", "tags", F.col("data_created").alias("created_ms")), have, "id", now_ms=self.now, retry=retry, days=self.setting.new_for_days, tag=missing or "")
        raw = scratch.written(pull.fetched_texts(wanted, "id", kind, self.site), kind).where("error is null")
        found = texts.chosen_text(raw, "id")
        self.report[f"{kind} urls"] = scratch.written(found.select("id", "report"), f"{kind}-report")
        plan = scratch.written(texts.text_plan(store.read().select("id", "data_created"), have.select("id", "hash"), found, "id"), f"{kind}-plan")
        counts = target.sync(plan, now=self.now, dry_run=self.dry_run)
        if missing and not self.dry_run and set(counts) & {"missing", "add"}:
            store.retag_to(texts.retagged_records(store.read(), plan, "id", missing=missing))
        return counts

    def video_texts(self, level: Level) -> dict:
        return self._texts(self.videos, self.transcripts, "videos", self._newest(self.videos, level.text_pages), retry=level.retry_missing, missing=MISSING)

    def publication_texts(self, level: Level) -> dict:
        if not level.deletions or not self.publications.version():
            return {}
        return self._texts(self.publications, self.full_texts, "publications", self.publications.read(), retry=False, missing=None)

    def term_counts(self, level: Level) -> None:
        if not self.dry_run:
            self.transcripts.update_term_counts(most=None if level.text_pages is None else level.text_pages * self._page())
            self.full_texts.update_term_counts()

    def summaries(self, level: Level) -> None:
        if self.dry_run:
            return
        people = self.videos.read().select("id", P.split_people(F.col("featuring")).alias("f"), P.split_people(F.col("interviewer")).alias("i"))
        self.transcripts.update_pseudo(ignored=texts.ignored_terms(people, "id", self.setting.unwanted_terms, "f", "i"))
        ids = self.full_texts.read().select("id")
        self.full_texts.update_pseudo(ignored=texts.ignored_terms(ids, "id", self.setting.unwanted_terms))

    # ---- 14-17: the customer-relations table ----

    def _people(self) -> DataFrame:
        return self.videos.read().select("id", P.split_people(F.col("featuring")).alias("featuring"), P.split_people(F.col("interviewer")).alias("interviewer"), "topics", "tag_names", "assets")

    def subjects(self, level: Level) -> dict:
        """Guests' subjects to the table, and the people that the table lacks to the report."""
        guests = self.guests.load(fresh=True)
        rows = self._people()
        found = enrich.guest_subjects(rows, people_col="featuring", subject_cols=["topics", "tag_names", "assets"], ignored=self.setting.ignorable)
        self.report["interviewers"] = rows.select(F.explode("interviewer").alias("person")).where("person <> ''").distinct()
        self.report["unknown people"] = enrich.unknown_people(rows, guests, people=["featuring", "interviewer"], name="key")
        ours = enrich.plain_names(found.select(F.col("guest").alias("key"), "subjects", F.col("guest").alias("written")), name="key", order="written").select("key", "subjects")
        theirs = guests.select("key", F.col("id").alias("crm_id"), F.coalesce(F.from_json("subjects", "array<string>"), F.array().cast("array<string>")).alias("subjects"))
        changed, only_ours = delivery.push_lists(theirs, ours, "key", "subjects", self.crm, scratch.written, pause=self.setting.pause, dry_run=self.dry_run)
        return {"changed": changed.count(), "not in the table": only_ours}

    def dimensions(self, level: Level) -> None:
        self.crm_shows.load(fresh=True)
        self.crm_videos.load(fresh=True)

    def crm_records(self, level: Level) -> dict:
        c = self.crm_local.begin()
        local = c.read("records") if c.has("records") else None
        target = self.spark.createDataFrame([], "id string, data_updated long, tags array<string>") if local is None else local.select("id", "data_updated", "tags")
        dim = lambda d, name: d.select(F.col(name).alias("name"), F.col("id").alias("crm_id"))
        stats = self.stats.read() if self.stats.version() else self.spark.createDataFrame([], "id string, n_comments long, n_replies long, likes long, dislikes long, tags array<string>")
        s = self.setting
        made = records.crm_records(self.videos.read(), target, shows=self.pulls.shows(), crm_shows=dim(self.crm_shows.load(), "key"), guests=dim(self.guests.load(), "key"), stats=stats, url_prefix=s.video_url, tiers=s.tiers, ignorable=s.ignorable, placeholder=s.placeholder, title_rules=s.title_rules)
        made = scratch.written(made, "crm-made")
        counts = {r.action: r.n for r in made.groupBy("action").agg(F.count("*").alias("n")).collect()}  # five rows
        if counts.get("older"):
            raise ValueError(f"{counts['older']} records of the table are newer than their source")
        self.report["issues"] = records.issue_table(made)
        if not self.dry_run:
            built = made.where("action in ('add', 'update')").select("id", "record", F.col("record.last_change").alias("data_updated"), "tags")
            if local is None:
                c.replace("records", built, "id")
            else:
                c.drop("records", made.where("action = 'delete'"))
                c.put("records", built)
            c.commit()
            self.crm_local.upkeep()
            if self.stats.version():
                self.stats.retag_to(records.consumed_tags(stats, made, "comments_changed"))
            self.videos.retag_to(records.consumed_tags(self.videos.read(), made, "changed"))
        return counts

    def push_crm(self, level: Level) -> dict:
        c = self.crm_local.begin()
        if not c.has("records"):
            return {}
        local = c.read("records")
        remote = self.crm_videos.load().select("website_id", F.col("id").alias("crm_id"))
        after, report = delivery.push_crm(local, remote, self.crm, scratch.written, pause=self.setting.pause, dry_run=self.dry_run)
        if not self.dry_run:
            moved = report.where("action = 'update' and error is null").select("id")
            c.put("records", after.join(moved, "id", "left_semi").select(local.columns))
            c.commit()
            self.crm_local.upkeep()
        return {f"{r.action}{'' if r.ok else ' failed'}": r.n for r in report.groupBy("action", F.col("error").isNull().alias("ok")).agg(F.count("*").alias("n")).collect()}

    # ---- 18: the search indexes ----

    def search(self, level: Level) -> dict:
        s, empty = self.setting, "id string, pushed struct<{0}>, current struct<{0}>, hash string, tags array<string>"
        guests = self.guests.load().select(F.col("key").alias("name"))
        stats = self.stats.read() if self.stats.version() else self.spark.createDataFrame([], "id string, n_comments long")
        made = {
            "videos": lambda: records.video_units(self.videos.read(), shows=self.pulls.shows(), guests=guests, stats=stats, texts=self.transcripts.read(), summaries=self.transcripts.read("pseudo"), url_prefix=s.video_url, tiers=s.tiers, ignorable=s.ignorable, placeholder=s.placeholder),
            "publications": lambda: records.publication_units(self.publications.read(), texts=self.full_texts.read(), summaries=self.full_texts.read("pseudo"), url_prefix=s.publication_url, tiers=s.tiers),
        }
        made["videos_full"] = made["videos"]
        kept = {"videos": self.transcripts, "videos_full": self.transcripts, "publications": self.full_texts}

        def index(name: str) -> delivery.Index:
            c = self.units[name].begin()

            def load() -> DataFrame:
                if c.has("units"):
                    return c.read("units")
                kinds = ", ".join(f"{c}:{t}" for c, t in made[name]().dtypes if c not in ("id", "hash", "issues"))
                return self.spark.createDataFrame([], empty.format(kinds))

            def with_pseudo() -> DataFrame:
                return kept[name].read().select("id", "text").join(kept[name].read("pseudo").select("id", "pseudo"), "id", "left")

            def save(rows: DataFrame) -> None:
                c.replace("units", rows, "id")
                c.commit()

            return delivery.Index(name, made[name], records.INDEXES[name], self.indexes[name], load, save, with_pseudo)

        names = [n for n in ("videos", "videos_full", "publications") if n in self.indexes and (n == "videos" or level.deletions)]
        if not self.publications.version():
            names = [n for n in names if n != "publications"]
        return delivery.push_indexes([index(n) for n in names], records.unit_plan, scratch.written, dry_run=self.dry_run, may_go_on=lambda: self.control.get("jobs") is not False)

    def retention(self, level: Level) -> dict[str, int]:
        """Drop all but the newest versions of everything that the run keeps; the number of versions left."""
        if self.dry_run:
            return {}
        kept = {"pulls": self.pulls, "videos": self.videos, "publications": self.publications, "stats": self.stats, "transcripts": self.transcripts, "full texts": self.full_texts}
        every = {n: s.versions for n, s in kept.items()} | {"paging": self.paging, "crm records": self.crm_local} | {f"units {n}": v for n, v in self.units.items()}
        for v in every.values():
            v.retain(self.setting.keep_versions)
        return {n: len(v.numbers()) for n, v in every.items()}

    def steps(self) -> list[tuple[str, Callable[[Level], object], tuple[str, ...]]]:
        """(name, step, the steps that it waits for)."""
        after = {
            "login": (), "probe": ("login",), "pull_videos": ("probe",), "sync_videos": ("pull_videos",), "pull_publications": ("login", "pull_videos"), "sync_publications": ("pull_publications",),
            "comments": ("sync_videos",), "video_texts": ("sync_videos",), "publication_texts": ("sync_publications",), "term_counts": ("video_texts", "publication_texts"), "summaries": ("term_counts",),
            "dimensions": ("login", "pull_videos"), "subjects": ("sync_videos",), "crm_records": ("comments", "video_texts", "subjects", "dimensions"), "push_crm": ("crm_records",),
            "search": ("summaries", "sync_publications", "crm_records"), "retention": ("search", "push_crm"),
        }
        return [(n, getattr(self, n), before) for n, before in after.items()]

    def run(self, level: int) -> dict[str, object]:
        """All steps at a level; the site is logged out of however it ends. The results by step: what it returned, or its error."""
        try:
            return run_graph(self.control, level, self.steps(), self.spark.sparkContext, at_once=self.setting.at_once)
        finally:
            self.site.logout()
