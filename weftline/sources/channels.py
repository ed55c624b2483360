"""A Python data source of channels: the newest messages of each, one input partition per channel.

It is backed by files (``<folder>/<channel>.jsonl``), since a live service is no part of the engine; a provider with the
same reader can stand in its place. Options: ``path``, ``limit`` (messages looked at per channel), ``peek`` (characters
kept of a text, 0 for all).
"""

from __future__ import annotations

import json
import os

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "source string, telegram_message_id bigint, date string, text string"


class Channel(InputPartition):
    def __init__(self, name: str, path: str):
        self.name, self.path = name, path


class ChannelReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.limit = int(options.get("limit", 100))
        self.peek = int(options.get("peek", 0))

    def partitions(self):
        names = sorted(f for f in os.listdir(self.folder) if f.endswith(".jsonl"))
        return [Channel(f[:-6], os.path.join(self.folder, f)) for f in names]

    def read(self, partition):
        with open(partition.path, encoding="utf-8") as f:
            messages = [json.loads(line) for line in f if line.strip()]
        messages.sort(key=lambda m: m.get("id", 0), reverse=True)
        for m in messages[: self.limit]:
            text = (m.get("text") or "").strip()
            if text:
                yield partition.name, m.get("id"), m.get("date"), text[: self.peek] if self.peek else text


class ChannelSource(DataSource):
    """``spark.dataSource.register(ChannelSource)``, then ``spark.read.format("channels")``."""

    @classmethod
    def name(cls):
        return "channels"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ChannelReader(self.options)
