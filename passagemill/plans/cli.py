"""The command line: config, build, dataset, job, evaluation-set, research-package."""

from __future__ import annotations

import argparse
import hashlib
import json
import sys

from ..functions.hashing import checksum
from ..operators import evalsets as E
from ..sources import evidence as V
from ..sources import manifest as S
from ..sources.store import ArtifactStore
from . import build as B
from . import config as C
from . import render


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="passagemill")
    top.add_argument("--human", action="store_true")
    top.add_argument("--store", default=".", help="base directory of the artifacts")
    groups = top.add_subparsers(dest="group", required=True)

    def command(group, name, *options):
        p = group.add_parser(name)
        for o, kw in options:
            p.add_argument(o, **kw)
        return p

    need = {"required": True}
    config = groups.add_parser("config").add_subparsers(dest="command", required=True)
    for name in ("show", "validate", "export"):
        command(config, name, ("--config", need))
    command(groups, "build", ("--config", need), ("--source", {}), ("--input-manifest", {"help": "old name of --source"}), ("--recipe", {}), ("--variant", {"help": "old name of --recipe"}), ("--storage-root", {"help": "old name of --store"}), ("--dataset", need), ("--experiment", {"default": "default"}), ("--run-id", {}))
    dataset = groups.add_parser("dataset").add_subparsers(dest="command", required=True)
    command(dataset, "show", ("uri", {}))
    command(dataset, "export", ("uri", {}), ("--to", need))
    job = groups.add_parser("job").add_subparsers(dest="command", required=True)
    for name in ("show", "watch", "cancel"):
        command(job, name, ("job_id", {}), ("--after", {"type": int, "default": 0}))
    sets = groups.add_parser("evaluation-set").add_subparsers(dest="command", required=True)
    command(sets, "exact-recall", ("--dataset", need), ("--name", need))
    command(sets, "import", ("--path", need), ("--name", need), ("--role", need))
    package = groups.add_parser("research-package").add_subparsers(dest="command", required=True)
    command(package, "create", ("--dataset", need), ("--name", need), ("--set", {"action": "append", "required": True}))
    command(package, "show", ("uri", {}))
    return top


def _dataset(store: ArtifactStore, uri: str) -> dict:
    manifest = store.get_json(store.key(uri))
    if manifest.get("schema") != B.DATASET_SCHEMA:
        raise ValueError("not a dataset")
    for shard in manifest["record_shards"]:  # one at a time
        if hashlib.sha256(store.get(store.key(shard["uri"]))).hexdigest() != shard["checksum"]:
            raise ValueError("the records were changed")
    return manifest


def _job_events(store: ArtifactStore, job_id: str, after: int) -> list[dict]:
    names = [n for n in store.files.names(store.path(f"jobs/{job_id}")) if n.startswith("events-")]
    rows = [r for n in names for r in store.rows(f"jobs/{job_id}/{n}")]
    return [r for r in rows if r["sequence"] > after]


def run(args: argparse.Namespace, spark=None) -> dict | list:
    if spark is None and "://" in args.store.removeprefix("file://"):  # only Spark reads such a store
        from ..session import local_session

        spark = local_session()
    store = ArtifactStore(args.store, spark=spark)
    match (args.group, getattr(args, "command", None)):
        case ("config", "show"):
            found = C.load(args.config)
            return {"config": C.redact(found.identity()), "sources": found.sources}
        case ("config", "validate"):
            C.load(args.config)
            return {"valid": True}
        case ("config", "export"):
            return {"toml": C.export(C.load(args.config))}
        case ("build", _):
            from ..session import local_session

            for old, new in (("variant", "recipe"), ("input_manifest", "source"), ("storage_root", "store")):
                if getattr(args, old):
                    print(f"--{old.replace('_', '-')} is the old name of --{new}", file=sys.stderr)
                    setattr(args, new, getattr(args, old))
            if not args.source:
                raise C.ConfigError("--source is needed")
            spark = spark or local_session()
            store = ArtifactStore(args.store, spark=spark)
            source = S.resolve(store, args.source, spark)
            paths = {r: store.of(r).path(store.of(r).key(r)) for r in source.manifest["evidence_refs"]}
            rows = V.scan(spark, *paths.values())
            return B.build(spark, store, rows, args.recipe or "paragraph-qa", C.load(args.config), args.dataset, source.checksum, args.experiment, args.run_id, context=S.context(spark, source.manifest), source_uri=args.source, overview=S.overview(source), loaded=V.file_counts(spark, paths))
        case ("dataset", "show"):
            return store.get_json(store.key(args.uri))
        case ("dataset", "export"):
            with open(args.to, "wb") as f:
                for shard in _dataset(store, args.uri)["record_shards"]:
                    f.write(store.get(store.key(shard["uri"])))
            return {"exported": args.to}
        case ("job", "cancel"):
            B.request_cancel(store, args.job_id)
            return {"job_id": args.job_id, "state": "cancellation_requested"}
        case ("job", _):
            return _job_events(store, args.job_id, args.after)
        case ("evaluation-set", "exact-recall"):
            from ..session import local_session

            manifest, spark = _dataset(store, args.dataset), spark or local_session()
            records = spark.read.json([store.path(store.key(s["uri"])) for s in manifest["record_shards"]]).drop("ordinal")
            return E.freeze_table(spark, store, E.exact_recall(records, manifest["dataset_version"]), args.name, "exact_recall")
        case ("evaluation-set", "import"):
            from ..session import local_session

            return E.import_lines(spark or local_session(), store, args.path, args.name, args.role)
        case ("research-package", "create"):
            from ..session import local_session

            manifest = store.get_json(store.key(args.dataset))
            return E.create_package(store, args.name, {"uri": args.dataset, "dataset_version": manifest["dataset_version"], "checksum": checksum(manifest)}, args.set, spark or local_session())
        case ("research-package", "show"):
            from ..session import local_session

            return E.load_package(store, args.uri, spark or local_session())
    raise AssertionError(args)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    try:
        report = run(args, spark)
    except C.ConfigError as e:
        print(json.dumps({"valid": False, "error": str(e)}))
        return 2
    print(render.human(report) if args.human else json.dumps(report, sort_keys=True, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
