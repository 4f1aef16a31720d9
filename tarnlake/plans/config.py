"""Configuration: typed, checked, from YAML."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

DOWNLOADER_KEYS = ("num_downloads", "max_nodes", "workers_per_node", "header", "image_size", "batch_size", "rate_multiplier", "default_rate_limit", "codecs")
TOOL_KEYS = ("threshold_size", "new_resize_size")
# Folders and files of the output root, as configurations may rename them.
STRUCTURE = {"urls_folder": "servers_batched", "images_folder": "downloaded_images", "schedules_folder": "schedules", "profiles_table": "servers_profiles", "ignored_table": "ignored_servers.csv", "inner_checkpoint_file": "inner_checkpoint.yaml", "tools_folder": "tools"}


@dataclass
class Config:
    """What a run needs. Keys beyond these are kept in ``extra`` for recipes."""

    path_to_output_folder: str
    path_to_input: str = ""
    initializer_type: str = ""
    schedule_rules: dict[int, int] = field(default_factory=lambda: {1: 1})
    output_structure: dict[str, str] = field(default_factory=dict)
    downloader_parameters: dict[str, Any] = field(default_factory=dict)
    tools_parameters: dict[str, Any] = field(default_factory=dict)
    suppress_unchanged_error: bool = False
    extra: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self):
        if not isinstance(self.path_to_output_folder, str) or not self.path_to_output_folder:
            raise ValueError("path_to_output_folder must be a path")
        self.schedule_rules = {int(k): int(v) for k, v in self.schedule_rules.items()}
        if not self.schedule_rules or any(v < 1 for v in self.schedule_rules.values()):
            raise ValueError("schedule_rules must map batches to one instance or more")
        if unknown := set(self.output_structure) - {*STRUCTURE, "logs_folder"}:
            raise ValueError(f"unknown keys in output_structure: {sorted(unknown)}")
        header = self.downloader_parameters.get("header", "")
        if not isinstance(header, str) or header and ":" not in header:
            raise ValueError('header must be text of the form "Key: value"')
        for name in ("batch_size", "image_size", "workers_per_node", "max_nodes", "default_rate_limit"):
            if not isinstance(self.downloader_parameters.get(name, 1), int) or self.downloader_parameters.get(name, 1) < 1:
                raise ValueError(f"downloader_parameters.{name} must be a whole number above 0")
        if not self.downloader_parameters.get("rate_multiplier", 0) >= 0:
            raise ValueError("downloader_parameters.rate_multiplier must not be negative")

    @classmethod
    def from_dict(cls, data: dict[str, Any]) -> Config:
        known = {f.name for f in fields(cls)} - {"extra"}
        if "path_to_output_folder" not in data:
            raise ValueError("path_to_output_folder is missing")
        return cls(**{k: v for k, v in data.items() if k in known and v is not None}, extra={k: v for k, v in data.items() if k not in known})

    @classmethod
    def from_path(cls, path: str) -> Config:
        import yaml

        data = yaml.safe_load(Path(path).read_text())
        if not isinstance(data, dict):
            raise ValueError(f"{path} holds no mapping")
        return cls.from_dict(data)

    def path(self, name: str) -> str:
        return f"{self.path_to_output_folder.rstrip('/')}/{self.output_structure.get(name) or STRUCTURE[name]}"

    def parameter(self, name: str, default: Any) -> Any:
        return self.downloader_parameters.get(name, default)

    @property
    def header(self) -> dict[str, str]:
        key, _, value = self.parameter("header", "").partition(":")
        return {key.strip(): value.strip()} if key else {}

    @property
    def workers(self) -> int:
        return self.parameter("max_nodes", 1) * self.parameter("workers_per_node", 1)
