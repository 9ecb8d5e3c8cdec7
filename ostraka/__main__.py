"""Commands on a warehouse folder; each is one method of :class:`ostraka.sources.warehouse.Warehouse`."""

from __future__ import annotations

import argparse
import sys


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ostraka", description=__doc__)
    top.add_argument("--warehouse", required=True, help="folder of the tables")
    groups = top.add_subparsers(dest="group", required=True)

    def command(group, name, *arguments, **options):
        one = group.add_parser(name)
        for a in arguments:
            one.add_argument(a)
        for a, default in options.items():
            kind = str if default is None else type(default)
            one.add_argument(f"--{a.replace('_', '-')}", default=default, **({"action": "store_true"} if kind is bool else {"type": kind}))
        return one

    m = groups.add_parser("metadata").add_subparsers(dest="command", required=True)
    command(m, "ingest", "source")
    command(m, "dump", "target")
    t = groups.add_parser("transcriptions").add_subparsers(dest="command", required=True)
    command(t, "ingest", "source")
    command(t, "dump", "target")
    command(t, "import", "source")
    command(t, "lemmatize", max_words=50)
    command(t, "search", "query", limit=10, lemmas=False)
    e = groups.add_parser("embeddings").add_subparsers(dest="command", required=True)
    for name in ("ingest", "update"):
        command(e, name, "address", "model", chunk_size=500, seed=0).add_argument("--sample", type=int)
    command(e, "delete", "model")
    command(e, "dump", "target", "model", kind="transcription")
    command(e, "import", "source", "model", kind="transcription")
    command(e, "evaluate", model=None, seed=0, output=None).add_argument("--sample", type=int)
    i = groups.add_parser("images").add_subparsers(dest="command", required=True)
    command(i, "settle", "source", "target", broken=None, lists=None)
    return top


def run(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    from pyspark.sql import SparkSession

    from ostraka.operators.providers import provider_for
    from ostraka.sources.warehouse import Warehouse

    w = Warehouse(SparkSession.builder.appName("ostraka").getOrCreate(), a.warehouse)
    match a.group, a.command:
        case "images", "settle":
            from ostraka.operators.images import outcome_chart
            from ostraka.sources.image_run import run_images

            done = run_images(w.spark, a.source, a.target, w.spark.read.text(a.broken) if a.broken else None)
            if a.lists:
                done.write_lists(a.lists)
            print(outcome_chart(done.counts().collect()))
        case "metadata", "ingest":
            w.ingest_metadata(a.source)
        case "metadata", "dump":
            w.dump_metadata(a.target)
        case "transcriptions", "ingest":
            w.ingest_documents(a.source)
        case "transcriptions", "dump":
            w.dump_documents(a.target)
        case "transcriptions", "import":
            w.import_documents(a.source)
        case "transcriptions", "lemmatize":
            w.lemmatize(max_words=a.max_words)
        case "transcriptions", "search":
            for r in w.search(a.query, a.limit, a.lemmas).collect():
                print(f"{r.score:.6f}\t{r.transcription_id}\t{r.source_path}")
        case "embeddings", ("ingest" | "update") as which:
            embed = provider_for(a.address, a.model).embed
            print(w.embed(a.model, embed, which == "update", a.sample, a.seed, a.chunk_size))
        case "embeddings", "delete":
            print(w.delete_model(a.model))
        case "embeddings", "dump":
            print(w.dump_model(a.target, a.model, a.kind))
        case "embeddings", "import":
            print(w.import_model(a.source, a.model, a.kind))
        case "embeddings", "evaluate":
            report = w.evaluate(a.model, a.sample, a.seed).to_markdown()
            if a.output:
                with open(a.output, "w", encoding="utf-8") as f:
                    f.write(report)
            else:
                print(report)


if __name__ == "__main__":
    run(sys.argv[1:])
