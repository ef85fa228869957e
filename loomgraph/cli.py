"""Commands: python -m loomgraph.cli COMMAND [options]. Output is JSON with sorted keys."""

from __future__ import annotations

import argparse
import logging

from loomgraph.plans.pipeline import Pipeline
from loomgraph.session import build_session
from loomgraph.settings import load_settings
from loomgraph.sources.sinks import render, write_subgraph

COMMANDS = ("ingest", "normalize", "build-graph", "build-embeddings", "query", "inspect-document", "inspect-gene", "export-subgraph", "validate", "run-pipeline", "resume")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomgraph")
    p.add_argument("command", choices=COMMANDS)
    p.add_argument("--profile")
    p.add_argument("--input-glob")
    p.add_argument("--work-folder")
    p.add_argument("--limit", type=int)
    p.add_argument("--force", action="store_true")
    p.add_argument("--gene")
    p.add_argument("--question")
    p.add_argument("--path")
    p.add_argument("--output")
    p.add_argument("--plain", action="store_true")
    p.add_argument("--log-file")
    return p


def main(argv: list[str] | None = None) -> str:
    args = parser().parse_args(argv)
    handlers: list[logging.Handler] = [logging.StreamHandler(), *([logging.FileHandler(args.log_file)] if args.log_file else [])]
    logging.basicConfig(level=logging.INFO, handlers=handlers)
    settings = load_settings(args.profile, input_glob=args.input_glob, work_folder=args.work_folder)
    pipe = Pipeline(build_session(), settings)
    glob, limit, force = args.input_glob, args.limit, args.force
    if args.command == "query" and not (args.gene or args.question):
        raise SystemExit("query needs --gene or --question")
    if args.command in ("inspect-gene", "export-subgraph") and not args.gene:
        raise SystemExit(f"{args.command} needs --gene")
    if args.command == "export-subgraph":
        write_subgraph(pipe.subgraph(args.gene), args.output or settings.at("subgraph"))
    result = {
        "ingest": lambda: {"ingested": pipe.ingest(glob, limit, force)},
        "normalize": lambda: {"normalized": pipe.normalize(glob, limit, force)},
        "build-graph": pipe.build_graph,
        "build-embeddings": lambda: {"indexed": pipe.build_index()},
        "query": lambda: pipe.query_gene(args.gene or args.question, args.question),
        "inspect-document": lambda: pipe.inspect(args.path or settings.input_glob),
        "inspect-gene": lambda: pipe.query_gene(args.gene),
        "export-subgraph": lambda: {"written": args.output or settings.at("subgraph")},
        "validate": lambda: pipe.validate(glob, limit or 2),
        "run-pipeline": lambda: pipe.run(glob, limit, force),
        "resume": lambda: pipe.resume(glob, limit),
    }[args.command]()
    text = render(result, pretty=not args.plain)
    print(text)
    return text


if __name__ == "__main__":
    main()
