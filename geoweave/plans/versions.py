"""The versions of the two lines of work: what each reads, keeps and writes."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class RetrievalVersion:
    """A declared retrieval run: which areas, which rule, and whether documents are kept once an area."""

    version: str
    title: str
    areas: str  # named, in_boundary, meaningful, specific
    rule: str
    deduplicated: bool
    max_gap: int | None = None

    @property
    def needs_frequencies(self) -> bool:
        return self.areas == "specific"


RETRIEVAL = {
    v.version: v
    for v in (
        RetrievalVersion("v1", "All named areas, name and context in any field", "named", "any_field", False),
        RetrievalVersion("v2", "Meaningful areas in a boundary, name in the URL or both in the text", "in_boundary", "url_or_context", False),
        RetrievalVersion("v3", "All meaningful areas, name in URL and text", "meaningful", "url_and_text", True),
        RetrievalVersion("v4", "All meaningful areas, name and context in the text", "meaningful", "text", True),
        RetrievalVersion("v5", "Specific names, country in the text", "specific", "text", True),
        RetrievalVersion("v6", "Specific names, country nearby in the text", "specific", "nearby", True, 500),
    )
}


def retrieval_version(version: str) -> RetrievalVersion:
    if version not in RETRIEVAL:
        raise ValueError(f"retrieval version must be one of {', '.join(RETRIEVAL)}")
    return RETRIEVAL[version]


@dataclass(frozen=True)
class Release:
    """A published version of a line of work; files are (split, file name)."""

    line: str
    version: str
    title: str
    sources: tuple[str, ...]
    suffix: str
    source_version: str | None = None
    metadata: tuple[str, ...] = ("manifest.json",)

    def data_files(self) -> list[tuple[str, str]]:
        split = "train" if len(self.sources) == 1 else None
        return [(split or s, f"data/{self.line}/{self.version}/{s}.{self.suffix}") for s in self.sources]

    def metadata_files(self) -> list[str]:
        return [f"metadata/{self.line}/{self.version}/{m}" for m in self.metadata]


def releases(sources: tuple[str, ...] = ("alpha", "beta")) -> list[Release]:
    """Every version; versions 1 to 4 of retrieval cover the first source only."""
    first = sources[:1]
    out = [Release("retrieval", v.version, v.title, first if i < 4 else sources, "jsonl", "v5" if v.version == "v6" else None, ("manifest.json", *(("name-frequency.json",) if v.needs_frequencies else ()))) for i, v in enumerate(RETRIEVAL.values())]
    out += [
        Release("retrieval", "v7", "Sentence lists added", sources, "jsonl", "v6"),
        Release("retrieval", "v8", "Documents with a topic term", sources, "jsonl", "v7", ("manifest.json", "topic-vocabulary.json")),
        Release("retrieval", "v9", "Topic sentences near the area's name", sources, "jsonl", "v8"),
        Release("retrieval", "v10", "Topic sentences that a classifier affirms", sources, "jsonl", "v9"),
        Release("lexical", "v1", "Every mention of every name", sources, "parquet"),
        Release("lexical", "v2", "Names classed by reuse and frequency", sources, "parquet", None, ("manifest.json", "name-inventory.json")),
        Release("lexical", "v3", "Mentions scored by evidence", sources, "parquet", "v2", ("comparison.md", "manifest.json", "name-inventory.json")),
    ]
    return out


LINES = {"retrieval": "frozen", "lexical": "active", "text-footprint": "planned"}


def catalog(spark: SparkSession, sources: tuple[str, ...] = ("alpha", "beta")) -> DataFrame:
    """One row a data file: line, status, version, title, source_version, split, file."""
    rows = [(r.line, LINES[r.line], r.version, r.title, r.source_version, split, file) for r in releases(sources) for split, file in r.data_files()]
    return spark.createDataFrame(rows, "line string, status string, version string, title string, source_version string, split string, file string")


def catalog_record(sources: tuple[str, ...] = ("alpha", "beta")) -> dict:
    """The catalog as one object: each line with its versions and latest one."""
    every = releases(sources)
    lines = []
    for line, status in LINES.items():
        own = [r for r in every if r.line == line]
        lines.append({"line": line, "status": status, "latest": own[-1].version if own else None, "versions": [asdict(r) | {"data_files": r.data_files(), "metadata_files": r.metadata_files()} for r in own]})
    return {"lines": lines}


def catalog_page(sources: tuple[str, ...] = ("alpha", "beta")) -> str:
    """The catalog as a Markdown table a line."""
    parts = ["# Catalog"]
    for line in catalog_record(sources)["lines"]:
        parts += [f"\n## {line['line']} ({line['status']})\n", "| version | title | reads | files |", "| --- | --- | --- | --- |"]
        parts += [f"| {v['version']} | {v['title']} | {v['source_version'] or '-'} | {', '.join(f for _, f in v['data_files'])} |" for v in line["versions"]]
    return "\n".join(parts) + "\n"
