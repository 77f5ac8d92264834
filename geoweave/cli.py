"""Command line: `python -m geoweave.cli scan|candidates|refine|compare|catalog ...`. A run prints one JSON line; expected errors go to stderr, exit code 2."""

from __future__ import annotations

import argparse
import importlib
import json
import sys

from geoweave.plans.versions import catalog_page, catalog_record, retrieval_version


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="geoweave", description=__doc__)
    commands = parser.add_subparsers(dest="command")
    for name in ("scan", "candidates"):
        c = commands.add_parser(name)
        c.add_argument("--documents", required=True)
        c.add_argument("--areas", required=True, help="Parquet table of areas, an .osm or .osm.pbf file, or several such files as source=path,source=path")
        c.add_argument("--output", required=True)
        c.add_argument("--version", required=True)
        c.add_argument("--ratio", type=float, default=0.001)
        c.add_argument("--chunk-rows", type=int, help="work in chunks of so many rows, and take up what an earlier run has completed")
        c.add_argument("--wave", type=int, help="chunks of one job; as many as cores if not given")
    commands.choices["scan"].add_argument("--country", required=True)
    commands.choices["candidates"].add_argument("--countries", required=True, help="source=Country,source=Country")
    c = commands.add_parser("refine", help="versions 7 to 10 of the evidence of version 6")
    c.add_argument("--evidence", required=True, help="what a scan has written")
    c.add_argument("--vocabulary", required=True, help="JSON file of topic terms; not read for v7")
    c.add_argument("--output", required=True)
    c.add_argument("--version", required=True, choices=("v7", "v8", "v9", "v10"))
    c.add_argument("--window", type=int, default=2, help="sentences between a topic and the name")
    c.add_argument("--segmenter", help="module:function that cuts texts into sentences")
    c.add_argument("--classifier", help="module:function that answers yes or no, for v10")
    c.add_argument("--prompt", default="", help="what the classifier asks; answers to another prompt are not reused")
    c = commands.add_parser("compare", help="a report of lexical candidates of versions 2 and 3")
    for side in ("v2", "v3"):
        c.add_argument(f"--{side}", required=True, help="what candidates has written")
    c = commands.add_parser("catalog")
    c.add_argument("--json", action="store_true", help="as one object")
    c.add_argument("--check", metavar="FILE", help="whether the file holds the catalog as it is now")
    return parser


def _area_paths(given: str) -> dict[str, str]:
    """Source key -> path; a single path is named by its file."""
    if "=" in given:
        return dict(x.split("=", 1) for x in given.split(","))
    return {given.rstrip("/").rsplit("/", 1)[-1].removesuffix(".pbf").removesuffix(".osm"): given}


def _areas(spark, given: str):
    paths = _area_paths(given)
    if all(p.endswith((".osm", ".osm.pbf")) for p in paths.values()):
        from geoweave.sources.osm import areas_of_sources

        return areas_of_sources(spark, paths)
    if len(paths) > 1:
        raise ValueError("several sources must be .osm or .osm.pbf files")
    return spark.read.parquet(given)


def _plugin(named: str | None):
    """The callable of `module:function`."""
    if named is None:
        return None
    module, _, function = named.partition(":")
    try:
        return getattr(importlib.import_module(module), function)
    except (ImportError, AttributeError, ValueError) as e:
        raise ValueError(f"no such plug-in: {named}") from e


def _written(spark, path: str):
    """A result of this command line, or a plain Parquet table."""
    from geoweave.plans.manifest import read_manifest

    known = read_manifest(spark, path)
    return spark.read.parquet(f"{path}/{known['folder']}" if known and "folder" in known else path)


def _refine(spark, args) -> dict:
    from geoweave.operators.classify import keep_yes, prompt_hash
    from geoweave.plans.answers import answered
    from geoweave.plans.manifest import produce
    from geoweave.plans.runs import refine
    from geoweave.sources.tables import fingerprint, read_vocabulary

    inputs = {"evidence_sha256": fingerprint(spark, args.evidence), "vocabulary_sha256": fingerprint(spark, args.vocabulary)}
    settings = {k: v for k, v in vars(args).items() if k != "output"} | inputs
    classifier = _plugin(args.classifier)
    if args.version == "v10" and classifier is None:
        raise ValueError("v10 needs a classifier")
    evidence, vocabulary, segmenter = _written(spark, args.evidence), read_vocabulary(spark, args.vocabulary), _plugin(args.segmenter)

    def build():
        if args.version != "v10":
            return refine(evidence, vocabulary, segmenter=segmenter, window=args.window)[args.version]
        # Of the sentences to ask about, so that they are not cut anew for each wave of answers.
        near, _ = produce(spark, f"{args.output}/v9", settings, lambda: refine(evidence, vocabulary, segmenter=segmenter, window=args.window)["v9"])
        header = inputs | {"classifier": args.classifier, "prompt_sha256": prompt_hash(args.prompt), "window": args.window}
        return keep_yes(answered(near, classifier, f"{args.output}/answers", header))

    rows, reused = produce(spark, args.output, settings, build)
    return {"command": "refine", "output": args.output, "reused": reused, "rows": rows.count(), "version": args.version}


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    if args.command is None:
        print("geoweave: choose a command")
        return 0
    if args.command == "catalog":
        told = json.dumps(catalog_record(), indent=2, sort_keys=True) + "\n" if args.json else catalog_page()
        if args.check is None:
            print(told, end="")
            return 0
        try:
            with open(args.check, encoding="utf-8") as f:
                same = f.read() == told
        except OSError as e:
            print(f"error: {e}", file=sys.stderr)
            return 2
        if not same:
            print(f"error: {args.check} is not the catalog as it is now", file=sys.stderr)
        return 0 if same else 2
    from pyspark.sql import SparkSession

    from geoweave.plans.manifest import produce
    from geoweave.plans.runs import candidates_in_chunks, find_candidates, name_frequencies, retrieve, retrieve_in_chunks
    from geoweave.sources.tables import fingerprint, read_documents

    try:
        spark = spark or SparkSession.builder.getOrCreate()
        if args.command == "refine":
            print(json.dumps(_refine(spark, args), sort_keys=True))
            return 0
        if args.command == "compare":
            from geoweave.plans.report import comparison_report

            print(comparison_report(_written(spark, args.v2), _written(spark, args.v3)), end="")
            return 0
        inputs = {"documents_sha256": fingerprint(spark, args.documents), "areas_sha256": {k: fingerprint(spark, p) for k, p in _area_paths(args.areas).items()}}
        settings = {k: v for k, v in vars(args).items() if k not in ("output", "wave")} | inputs
        documents, areas = read_documents(spark, args.documents), _areas(spark, args.areas)
        if not args.areas.rstrip("/").endswith(".parquet"):
            # Map files are put together once, not for each step that reads the areas.
            areas = produce(spark, f"{args.output}/areas", inputs["areas_sha256"], lambda: _areas(spark, args.areas), conflict="rebuild")[0]
        frequencies = None
        if args.version in (("v5", "v6") if args.command == "scan" else ("v2", "v3")):
            # Made once for the same inputs, and read again by later runs.
            frequencies = produce(spark, f"{args.output}/frequencies", inputs, lambda: name_frequencies(documents, areas))[0]
        if args.command == "scan":
            retrieval_version(args.version)
            options = {"country": args.country, "ratio": args.ratio, "frequencies": frequencies}
            whole, in_chunks = retrieve, retrieve_in_chunks
        else:
            options = {"countries": dict(x.split("=", 1) for x in args.countries.split(",")), "ratio": args.ratio, "frequencies": frequencies}
            whole, in_chunks = find_candidates, candidates_in_chunks
        if args.chunk_rows is not None:
            done = in_chunks(documents, areas, args.version, f"{args.output}/chunks", inputs, rows_per_chunk=args.chunk_rows, chunks_per_wave=args.wave, **options)
            rows, reused = produce(spark, args.output, settings, lambda: done.found)
            counted = done.counters() | {"seconds": round(done.seconds, 3)}
        else:
            rows, reused = produce(spark, args.output, settings, lambda: whole(documents, areas, args.version, **options))
            counted = {}
        print(json.dumps({"command": args.command, "output": args.output, "reused": reused, "rows": rows.count(), "version": args.version} | counted, sort_keys=True))
    except (OSError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
