"""The identity bank as tables: adoption of ghosts, upserts, replacement, purges, and the enrollment fold."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..config import DEFAULT_RANK, ENROLL_RANK, SETTINGS, Settings
from ..functions.bibs import compatible
from ..functions.text import uuid5
from ..functions.vectors import cosine_distance, norm
from ..sources.work import written
from .folds import fold_groups
from .gallery import close_pairs


def ghost_matches(confirmed: DataFrame, ghosts: DataFrame, by: list[str], face_ok: float, reid_ok: float, face_floor: float) -> DataFrame:
    """Pairs (confirmed_id, bib, ghost_id, face_dist, reid_dist) of equal ``by`` that pass the vector
    gate. Distances with a null vector are null, and fail. Every way through the gate needs a face
    similarity, so pairs come from a blocked matrix product on faces, and the gate decides on these."""
    # lengths once a vector, not once a pair
    sides = lambda x: [e for v in ("face", "reid") for e in (F.col(v).alias(f"{v}_{x}"), norm(F.col(v)).alias(f"{v}_len_{x}"))]
    a = confirmed.select(*by, F.col("id").alias("confirmed_id"), "bib", *sides("a"))
    b = ghosts.select(*by, F.col("id").alias("ghost_id"), *sides("b"))
    near = close_pairs(a.withColumnRenamed("face_a", "_face"), b.withColumnRenamed("face_b", "_face"), by, min(face_ok, face_floor), "confirmed_id", "ghost_id", "_face")
    a, b = a.drop(*by), b.drop(*by)
    dist = lambda v: cosine_distance(*[F.col(f"{v}_{x}") for x in "ab"], *[F.col(f"{v}_len_{x}") for x in "ab"])
    m = near.join(a, "confirmed_id").join(b, "ghost_id").withColumns({"face_dist": dist("face"), "reid_dist": dist("reid")})
    ok = (F.col("face_dist") <= 1 - face_ok) | ((F.col("face_dist") <= 1 - face_floor) & (F.col("reid_dist") <= 1 - reid_ok))
    return m.where(F.coalesce(ok, F.lit(False))).select(*by, "confirmed_id", "bib", "ghost_id", "face_dist", "reid_dist")


def gated_pairs(confirmed: DataFrame, ghosts: DataFrame, by: list[str], face_ok: float, reid_ok: float, face_floor: float) -> DataFrame:
    """The pairs of ``ghost_matches`` without their distances (``by``, confirmed_id, bib, ghost_id): the gate decides where the
    faces are multiplied, so no vector is joined to a pair."""
    least = min(face_ok, face_floor)
    return close_pairs(confirmed.select(*by, F.col("id").alias("confirmed_id"), "bib", "face", "reid"), ghosts.select(*by, F.col("id").alias("ghost_id"), "face", "reid"), by, least, "confirmed_id", "ghost_id", "face", gate=("reid", face_ok, reid_ok, face_floor), keep="bib")


def without_shared_photos(matches: DataFrame, subjects: DataFrame) -> DataFrame:
    """Matches whose two identities never stand in one photo. subjects: identity_id, photo_id.

    Identities of one photo meet in a join on the photo, and equal pairs are combined before they are
    shuffled, so what is kept grows with the pairs of identities and not with their photos."""
    matches = written(matches, "matches")
    in_photo = lambda side: subjects.select("photo_id", F.col("identity_id").alias(side)).join(matches.select(side).distinct(), side, "left_semi")
    both = in_photo("ghost_id").join(in_photo("confirmed_id"), "photo_id").select("confirmed_id", "ghost_id").distinct()
    return matches.join(both, ["confirmed_id", "ghost_id"], "left_anti")


def without_veto(matches: DataFrame, subjects: DataFrame) -> DataFrame:
    """Matches in which every reading of the ghost is compatible with the bib. subjects: identity_id, ocr_bib."""
    read = subjects.where("ocr_bib is not null").groupBy(F.col("identity_id").alias("ghost_id")).agg(F.collect_set("ocr_bib").alias("_read"))
    fits = F.coalesce(F.forall("_read", lambda r: compatible(r, F.col("bib"))), F.lit(True))
    return matches.join(read, "ghost_id", "left").where(fits).drop("_read")


def adopt(confirmed: DataFrame, ghosts: DataFrame, subjects: DataFrame, by: list[str], face_ok: float, reid_ok: float, face_floor: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Adopt ghosts for all confirmed identities at once: (subjects, ghosts left, adoptions).

    A ghost that several identities could adopt goes to the smallest bib. Subjects of adopted ghosts
    without an assigned bib get the identity, its bib and the match type ghost_adopted; ghosts
    that are adopted and keep no subject are purged.
    """
    near = gated_pairs(confirmed, ghosts, by, face_ok, reid_ok, face_floor).select("ghost_id", "confirmed_id", "bib")
    m = without_veto(without_shared_photos(near, subjects), subjects)
    w = Window.partitionBy("ghost_id").orderBy("bib", "confirmed_id")
    won = written(m.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("ghost_id", "confirmed_id", "bib"), "adoptions")
    s = subjects.join(won.select(F.col("ghost_id").alias("identity_id"), F.col("confirmed_id").alias("_c"), F.col("bib").alias("_b")), "identity_id", "left")
    take = F.col("_c").isNotNull() & F.col("assigned_bib").isNull()
    changed = {"identity_id": F.when(take, F.col("_c")).otherwise(F.col("identity_id")), "match_type": F.when(take, "ghost_adopted").otherwise(F.col("match_type")), "assigned_bib": F.when(take, F.col("_b")).otherwise(F.col("assigned_bib"))}
    s = s.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in subjects.columns])
    empty = won.select(F.col("ghost_id").alias("id")).join(s.select(F.col("identity_id").alias("id")).distinct(), "id", "left_anti")
    return s, ghosts.join(empty, "id", "left_anti"), won


def release_subjects(subjects: DataFrame, releases: DataFrame) -> DataFrame:
    """Subjects after their identities were taken over: those whose match type is trusted as little as the
    newcomer's or less go to the ghost that holds the old vectors, without a bib. releases:
    identity_id, ghost_id, rank (of the newcomer); one row per identity."""
    r = releases.select(F.col("identity_id").alias("_i"), F.col("ghost_id").alias("_ghost"), F.col("rank").alias("_rank"))
    s = subjects.join(r, F.col("identity_id") == F.col("_i"), "left")
    gone = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in ENROLL_RANK.items() for x in kv]), F.col("match_type")) >= F.col("_rank"), F.lit(False))
    changed = {"identity_id": F.when(gone, F.col("_ghost")).otherwise(F.col("identity_id")), "assigned_bib": F.when(~gone, F.col("assigned_bib")), "match_type": F.when(gone, "ghost").otherwise(F.col("match_type"))}
    return s.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in subjects.columns])


def purge_empty(identities: DataFrame, subjects: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """``identities`` without those (of ``candidates``, if given) that have no subject."""
    empty = (identities if candidates is None else candidates).select("id").distinct().join(subjects.select(F.col("identity_id").alias("id")).distinct(), "id", "left_anti")
    return identities.join(empty, "id", "left_anti")


def upsert(table: DataFrame, incoming: DataFrame, keys: list[str], order: str, fresh: dict | None = None) -> DataFrame:
    """Merge by key: the last incoming row (by ``order``) updates its non-null columns, other columns
    keep what the table has; new keys are added, with ``fresh`` columns computed for them. Returns the new table."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    last = incoming.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
    new = last.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in table.columns if c in last.columns and c not in keys], F.lit(True).alias("_new"))
    merged = table.withColumn("_old", F.lit(True)).join(new, keys, "full")
    value = lambda c: F.coalesce(F.col(f"_n_{c}"), F.col(c)) if f"_n_{c}" in new.columns else F.col(c)
    out = {c: value(c) for c in table.columns if c not in keys}
    for c, v in (fresh or {}).items():
        out[c] = F.when(F.col("_old").isNull(), v).otherwise(out[c])
    return merged.select(*[F.col(c) if c in keys else out[c].alias(c) for c in table.columns])


def replace_rows(table: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Delete by key, then insert: a burst that comes again replaces what it wrote before."""
    return table.join(incoming.select(*keys).distinct(), keys, "left_anti").unionByName(incoming.select(*table.columns))


def wipe(tables: dict[str, DataFrame], project: str, column: str = "project_id") -> tuple[dict[str, DataFrame], DataFrame]:
    """The tables without a project's rows, and (table, deleted) counts."""
    counts = None
    for name, t in tables.items():
        c = t.where(F.col(column) == project).agg(F.count("*").alias("deleted")).select(F.lit(name).alias("table"), "deleted")
        counts = c if counts is None else counts.unionByName(c)
    return {n: t.where(~F.col(column).eqNullSafe(project)) for n, t in tables.items()}, counts


# ---- enrollment: an ordered fold per (project, bib) -------------------------------------------------

STATE = "id string, project_id string, bib string, face array<double>, reid array<double>, sighting_count int, enrollment_type string, shards array<struct<face: array<double>, reid: array<double>, count: int>>"

@cache
def _state_type() -> StructType:
    """STATE as a type; the parser needs a session, so not at import."""
    return _parse_datatype_string(STATE)


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v)
    return v / n if n > 0 else v


def _sim(a, b) -> float:
    if a is None or b is None:
        return 0.0
    n = np.linalg.norm(a) * np.linalg.norm(b)
    return float(a @ b / n) if n > 0 else 0.0


def _blend(old, new, keep: float):
    if old is None:
        return None if new is None else _unit(new)
    return old if new is None else _unit(keep * old + (1 - keep) * new)


def identity_of(*parts) -> str:
    """A deterministic id, the same when a batch is run again."""
    return str(uuid.UUID(bytes=hashlib.sha1("\x1f".join(map(str, parts)).encode()).digest()[:16], version=5))


class Enrollment:
    """One bib's identity while its enrollments are folded in, with the ghosts they give off."""

    def __init__(self, project: str, bib: str, settings: Settings = SETTINGS, compat: bool = True, state: dict | None = None):
        self.project, self.bib, self.s, self.compat = project, bib, settings, compat
        self.ghosts: list[dict] = []
        self.now = state

    def _ghost(self, face, reid, why: str, seq) -> str:
        g = {"id": identity_of("ghost", self.project, self.bib, why, seq), "project_id": self.project, "bib": None, "face": face, "reid": reid, "sighting_count": 1, "enrollment_type": "ghost", "shards": []}
        self.ghosts.append(g)
        return g["id"]

    def _shard(self, face, reid) -> bool:
        """True if a new shard was made, so that the primary centroid stays as it is. A shard that is
        near takes the vectors in, and the primary is blended too."""
        now, s = self.now, self.s
        if now["sighting_count"] < s.shard_min_count:
            return False
        if 1 - max(_sim(face, now["face"]), _sim(reid, now["reid"])) < s.shard_dist:
            return False
        for shard in now["shards"]:
            if 1 - max(_sim(face, shard["face"]), _sim(reid, shard["reid"])) < s.shard_dist:
                shard["face"], shard["reid"] = _blend(shard["face"], face, s.ema), _blend(shard["reid"], reid, s.ema)
                shard["count"] += 1
                return not self.compat
        if len(now["shards"]) >= s.max_shards:
            return False
        now["shards"].append({"face": face, "reid": reid, "count": 1})
        return True

    def add(self, seq, face, reid, kind: str) -> str:
        """Fold one enrollment in; returns the id that its subjects belong to."""
        s, rank = self.s, lambda k: ENROLL_RANK.get(k, DEFAULT_RANK)
        face, reid = (None if v is None else _unit(np.asarray(v, np.float64)) for v in (face, reid))
        if self.now is None:
            self.now = {"id": identity_of("identity", self.project, self.bib), "project_id": self.project, "bib": self.bib, "face": face, "reid": reid, "sighting_count": 1, "enrollment_type": kind, "shards": []}
            if self.compat and (face is not None or reid is not None):
                self.now["sighting_count"] = 2  # the row that was just made counts as seen again
            return self.now["id"]
        now = self.now
        if face is None and reid is None:
            return now["id"]
        held = now["face"] is not None or now["reid"] is not None
        if held and now["sighting_count"] >= 2:
            both_faces = face is not None and now["face"] is not None
            sim = _sim(face, now["face"]) if both_faces else _sim(reid, now["reid"])
            if rank(kind) < rank(now["enrollment_type"]):
                self._ghost(now["face"], now["reid"], "released", seq)
                now.update(face=face, reid=reid if reid is not None else now["reid"], enrollment_type=kind, sighting_count=2)
                return now["id"]
            if sim < s.enroll_sim:
                return self._ghost(face, reid, "rejected", seq)
        if not self._shard(face, reid):
            now["face"], now["reid"] = _blend(now["face"], face, s.ema), _blend(now["reid"], reid, s.ema)
        now["sighting_count"] += 1
        if rank(kind) < rank(now["enrollment_type"]):
            now["enrollment_type"] = kind
        return now["id"]

    def given_off(self) -> list[dict]:
        """The ghosts since the last call."""
        out, self.ghosts = [self._plain(g) for g in self.ghosts], []
        return out

    def rows(self) -> list[dict]:
        return [*([self._plain(self.now)] if self.now else []), *self.given_off()]

    @staticmethod
    def _plain(r: dict) -> dict:
        plain = lambda v: None if v is None else np.asarray(v, np.float64).tolist()
        return r | {"face": plain(r["face"]), "reid": plain(r["reid"]), "shards": [x | {"face": plain(x["face"]), "reid": plain(x["reid"])} for x in r["shards"]]}


def ensure(enrollments: DataFrame, bank: DataFrame | None = None, settings: Settings = SETTINGS, compat: bool = True) -> DataFrame:
    """``enroll``, and a new ghost for each enrollment without a bib, named by its project and seq."""
    known = enroll(enrollments, bank, settings, compat)
    name = F.concat_ws("\x1f", F.lit("ghost"), "project_id", F.lit(""), F.lit("unread"), F.col("seq").cast("string"))
    kinds = dict(known.dtypes)
    ghosts = enrollments.where("bib is null").select(uuid5(name).alias("id"), "project_id", F.lit(None).cast("string").alias("bib"), F.col("face").cast("array<double>").alias("face"), F.col("reid").cast("array<double>").alias("reid"), F.lit(1).alias("sighting_count"), F.lit("ghost").alias("enrollment_type"), F.array().cast(kinds["shards"]).alias("shards"))
    return known.unionByName(ghosts).dropDuplicates(["id"])


def enroll(enrollments: DataFrame, bank: DataFrame | None = None, settings: Settings = SETTINGS, compat: bool = True) -> DataFrame:
    """Fold enrollments (project_id, bib, seq, face, reid, match_type) into identities, in the order of
    seq: a table of STATE with the identities of all bibs touched and their new ghosts. ``bank``: a
    table of STATE to start from. compat keeps two habits of the reference: a new identity with
    vectors counts 2 sightings, and a shard that takes vectors in lets the primary take them too."""
    vec = lambda v: None if v is None else np.asarray(v, np.float64)

    def fold(rows: Iterator[dict]) -> Iterator[dict]:
        """Constant state: ghosts are given off as they come."""
        e = None
        for r in rows:
            if e is None:
                held = r["state"]
                if held is not None:
                    held = held | {"face": vec(held["face"]), "reid": vec(held["reid"]), "shards": [x | {"face": vec(x["face"]), "reid": vec(x["reid"])} for x in held["shards"] or ()]}
                e = Enrollment(r["project_id"], r["bib"], settings, compat, held)
            if r["state"] is None:
                e.add(r["seq"], r["face"], r["reid"], r["match_type"])
            yield from e.given_off()
        yield from e.rows()

    columns = ["project_id", "bib", "seq", "face", "reid", "match_type"]
    doubles = "array<double>"
    new = enrollments.where(F.col("bib").isNotNull()).select(*[F.col(c).cast(doubles).alias(c) if c in ("face", "reid") else c for c in columns], F.lit(None).cast(_state_type()).alias("state"))
    if bank is None:
        return fold_groups(new, ["project_id", "bib"], ["seq"], fold, STATE)
    names = [f.name for f in _state_type().fields]
    nothing = {c: F.lit(None).cast(t).alias(c) for c, t in new.dtypes}
    old = bank.where(F.col("bib").isNotNull()).select("project_id", "bib", *[nothing[c] for c in columns[2:]], F.struct(*names).cast(_state_type()).alias("state"))
    return fold_groups(old.unionByName(new), ["project_id", "bib"], [F.col("state").isNull(), "seq"], fold, STATE).unionByName(bank.where(F.col("bib").isNull()).select(*names))
