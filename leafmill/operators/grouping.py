"""Pages of a file into documents: agreement of identity fields, vetoes, ties, and one back page a document.

``score_pairs``, ``place`` and ``one_back`` are set queries for files none of whose faces can become a child.
``group_exact`` walks each file in rank order, as faces that look like back pages demand.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = ("lease", "operator", "district", "well", "api", "field_name")
EVIDENCE = (*IDENTITY, "total_depth")  # the depth can agree but never vetoes
LEAST = 2


def agreeing(left: str, right: str, fields=EVIDENCE) -> Column:
    """Names of the fields that both sides have and agree on."""
    return F.filter(F.array(*(F.when(F.col(f"{left}.{f}") == F.col(f"{right}.{f}"), F.lit(f)) for f in fields)), lambda f: f.isNotNull())


def contradicted(left: str, right: str) -> Column:
    out = F.lit(False)
    for f in IDENTITY:
        out = out | F.coalesce(F.col(f"{left}.{f}") != F.col(f"{right}.{f}"), F.lit(False))
    return out


def richness(page: str) -> Column:
    return sum((F.col(f"{page}.{f}").isNotNull().cast("int") for f in EVIDENCE[1:]), F.col(f"{page}.{EVIDENCE[0]}").isNotNull().cast("int"))


def score_pairs(pages: DataFrame, file: str = "file", page: str = "page") -> DataFrame:
    """Candidates against the faces of their file. ``pages``: file, page, face, candidate, family, values (struct).

    An equi-join on the file; a file has tens of pages, and a large one is split by Spark's skew join.
    """
    faces = pages.where("face").select(file, F.col(page).alias("parent"), F.col("family").alias("parent_family"), F.col("values").alias("p"))
    backs = pages.where("candidate AND NOT face").select(file, page, "family", F.col("values").alias("c"))
    pairs = backs.join(faces, file)
    differs = F.coalesce(F.col("family") != F.col("parent_family"), F.lit(False))
    return pairs.select(file, page, "parent", differs.alias("family_conflict"), agreeing("c", "p").alias("fields"), contradicted("c", "p").alias("contradicted"))


def place(pages: DataFrame, pairs: DataFrame, least: int = LEAST, file: str = "file", page: str = "page") -> DataFrame:
    """Step 4: for each candidate its parent, or the reason why it has none. More than one best parent is a tie."""
    ok = ~F.col("family_conflict") & ~F.col("contradicted") & (F.size("fields") >= least)
    best = F.max(F.when(ok, F.size("fields"))).over(Window.partitionBy(file, page))
    rows = pairs.withColumn("best", best)
    at_best = ok & (F.size("fields") == F.col("best"))
    per = rows.groupBy(file, page).agg(
        F.count_if(at_best).alias("winners"),
        F.min(F.when(at_best, F.col("parent"))).alias("parent"),
        F.min(F.when(at_best, F.array_join("fields", ","))).alias("agreed"),
        F.max(F.col("contradicted") & ~F.col("family_conflict")).alias("any_contradicted"),
        F.max("family_conflict").alias("any_family"),
    )
    kinds = pages.select(file, page, "face", "candidate").join(per, [file, page], "left")
    reason = (
        F.when(F.col("face"), None)
        .when(~F.col("candidate"), "not_a_candidate")
        .when(F.col("winners").isNull(), "no_face")
        .when(F.col("winners") > 1, "tie")
        .when(F.col("winners") == 1, None)
        .when(F.col("any_contradicted"), "contradicted")
        .when(F.col("any_family"), "different_form")
        .otherwise("below_threshold")
    )
    placed = (F.col("winners") == 1) & ~F.col("face")
    return kinds.select(file, page, "face", F.when(placed, F.col("parent")).alias("parent"), F.when(placed, F.col("agreed")).alias("agreed"), reason.alias("reason"))


def one_back(placed: DataFrame, file: str = "file", page: str = "page") -> DataFrame:
    """Step 5 without paper: of a face with several back pages none can be told to be its own, so all stand down."""
    n = F.count(F.lit(1)).over(Window.partitionBy(file, "parent"))
    rows = placed.withColumn("slot", F.when(F.col("parent").isNotNull(), n))
    crowded = F.coalesce(F.col("slot") > 1, F.lit(False))
    return rows.select(file, page, "face", F.when(~crowded, F.col("parent")).alias("parent"), F.when(~crowded, F.col("agreed")).alias("agreed"), F.when(crowded, "slot_tie").otherwise(F.col("reason")).alias("reason"))


def group_documents(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """G1, form (b): file, page, face, parent, agreed, reason; every page has one row."""
    return one_back(place(pages, score_pairs(pages), least))


def group_file(pages: list[dict], confirmed: set[tuple[int, int]] = frozenset(), least: int = LEAST) -> list[tuple]:
    """G1, form (a): (page, is document, parent, agreed, reason) for each page of one file.

    A page: page, face, candidate, family, values (dict), looks_back, section (whether it can be displaced). Pairs in
    ``confirmed`` (face, page) lie on one sheet of paper.
    """
    filled = lambda v: sum(v.get(f) is not None for f in EVIDENCE)
    faces = sorted((p for p in pages if p["face"]), key=lambda p: (-filled(p["values"]), p["page"]))
    reason: dict[int, str | None] = {p["page"]: "not_a_candidate" for p in pages if not p["face"] and not p["candidate"]}
    parent: dict[int, tuple[int, tuple[str, ...], bool]] = {}
    parents: list[dict] = []

    def find(child: dict, pool: list[dict]):
        if not pool:
            return "no_face"
        seen, options = set(), []
        for f in pool:
            if child["family"] is not None and f["family"] is not None and child["family"] != f["family"]:
                seen.add("different_form")
                continue
            both = [n for n in EVIDENCE if child["values"].get(n) is not None and f["values"].get(n) is not None]
            if any(child["values"][n] != f["values"][n] for n in both if n in IDENTITY):
                seen.add("contradicted")  # even where the paper confirms: one of the readings is wrong
                continue
            same = tuple(n for n in both if child["values"][n] == f["values"][n])
            sure = (f["page"], child["page"]) in confirmed
            if sure or len(same) >= least:
                options.append((sure, len(same), f["page"], same))
        if not options:
            return next((r for r in ("contradicted", "different_form") if r in seen), "below_threshold")
        best = max(o[:2] for o in options)
        top = [o for o in options if o[:2] == best]
        return "tie" if len(top) > 1 else (top[0][2], top[0][3], top[0][0])

    for f in faces:
        got = find(f, parents) if f.get("looks_back") and parents else None
        if isinstance(got, tuple):
            parent[f["page"]] = got
        else:
            parents.append(f)
    for c in sorted((p for p in pages if p["candidate"] and not p["face"]), key=lambda p: p["page"]):
        got = find(c, parents)
        if isinstance(got, tuple):
            parent[c["page"]] = got
        else:
            reason[c["page"]] = got
    by = {p["page"]: p for p in pages}
    for f in parents:
        mine = [c for c, (at, _, _) in parent.items() if at == f["page"]]
        paper = [c for c in mine if parent[c][2]]
        out = list(paper) if len(paper) > 1 else []
        if len(paper) == 1:
            out += [c for c in mine if c not in paper and (by[c].get("section") or by[c]["face"])]
        left = [c for c in mine if c not in paper and c not in out]
        if len(left) > 1:
            out += left
        for c in out:
            del parent[c]
            reason[c] = None if by[c]["face"] else "slot_tie"
    return [(p["page"], p["face"] and p["page"] not in parent, *((parent[p["page"]][0], ",".join(parent[p["page"]][1])) if p["page"] in parent else (None, None)), reason.get(p["page"])) for p in sorted(pages, key=lambda p: p["page"])]


def group_exact(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """G1, form (a): one task a file, as the walk is sequential inside a file. Optional columns: looks_back, section, confirmed (face pages)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, sure = [], set()
        for r in pdf.to_dict("records"):
            values = {n: (None if r[n] is None or r[n] != r[n] else r[n]) for n in EVIDENCE}
            rows.append({"page": r["page"], "face": r["face"], "candidate": r["candidate"], "family": r["family"], "values": values, "looks_back": r.get("looks_back", False), "section": r.get("section", False)})
            sure |= {(int(f), r["page"]) for f in (r.get("confirmed") if r.get("confirmed") is not None else [])}
        out = pd.DataFrame(group_file(rows, sure, least), columns=["page", "face", "parent", "agreed", "reason"])
        out.insert(0, "file", pdf["file"].iloc[0])
        return out.astype({"parent": "Int64"})

    flat = pages.select(*(c for c in pages.columns if c != "values"), *(F.col(f"values.{n}").alias(n) for n in EVIDENCE))
    return flat.groupBy("file").applyInPandas(run, "file long, page long, face boolean, parent long, agreed string, reason string")
