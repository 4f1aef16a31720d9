"""Two commands: ``python -m tarnlake.cli download CONFIG`` and ``python -m tarnlake.cli tool CONFIG NAME``."""

from __future__ import annotations

import argparse

from tarnlake.plans.stages import apply_tools, download_images


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tarnlake")
    sub = parser.add_subparsers(dest="command", required=True)
    get = sub.add_parser("download", help="batch, schedule and fetch what a configuration names")
    get.add_argument("config")
    for stage in ("batched", "profiled", "schedules_created"):
        get.add_argument(f"--reset-{stage.replace('_', '-')}", dest=f"reset_{stage}", action="store_true")
    tool = sub.add_parser("tool", help="run one tool over the downloaded images")
    tool.add_argument("config")
    tool.add_argument("name")
    tool.add_argument("--reset", action="store_true")
    given = parser.parse_args(args)
    if given.command == "tool":
        print(f"version {apply_tools(given.config, given.name, reset=given.reset)}")
        return 0
    reset = tuple(s for s in ("batched", "profiled", "schedules_created") if getattr(given, f"reset_{s}"))
    return 0 if download_images(given.config, reset=reset) else 1


if __name__ == "__main__":
    raise SystemExit(main())
