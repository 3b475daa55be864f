"""Timing of the headline queries; prints one JSON line.

Tables that are built once and queried often (credits, triples, search indexes) are timed as
``build_*``: one cold run each. A query is run twice, ``<name>_first`` and ``<name>``; all of its rows
are computed and dropped.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from celluloid import build_session  # noqa: E402
from celluloid.adapters import queries as registered  # noqa: E402
from celluloid.session import own_scratch  # noqa: E402

BUILDS = {
    "build_tables": registered.film_tables,
    "build_names": lambda spark, sf: registered.names("titles", spark, sf),
    "build_triples": registered.stored_triples,
    "build_title_index": lambda spark, sf: registered.index("titles", spark, sf),
    "build_document_index": lambda spark, sf: registered.index("documents", spark, sf),
    "build_details": registered._details_at,
    "build_items": registered._items_at,
}
HEADLINE = (
    "collaborations",
    "title_neighbors",
    "person_neighbors",
    "lookup_title",
    "scan_movie_export_jsonl",
    "scan_akas_tsv",
    "gate_principals",
    "upsert_credits",
    "insert_ignore_credits",
    "merge_entities",
    "replace_movie_credits",
    "link_upsert",
    "pending_hydrations",
    "hydrate_movie_credits",
    "entity_claims",
    "artifact_dedup",
    "title_documents",
    "document_postings",
    "search_titles_all",
    "search_documents_any",
    "search_documents_phrase",
    "triple_counters",
    "graph_profile_live",
    "neighbors_of_title",
    "collaborations_from_triples",
    "directed_films",
    "recurring_collaborators",
    "nquads_lines",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    own_scratch(spark)
    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)

    for name, build in BUILDS.items():
        timed(name, lambda build=build: build(spark, sf_dir))
    all_queries = registered.queries()
    for name in HEADLINE:
        for turn in (f"{name}_first", name):
            timed(turn, lambda name=name: all_queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    total = round(sum(times.values()), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": float(scale)}))
    spark.stop()


if __name__ == "__main__":
    main()
