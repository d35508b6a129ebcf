"""Filter pipelines from configuration: a list of filters with arguments, compiled to one plan over a frame of documents."""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame

from quern.operators import filters

_HERE = os.path.join(os.path.dirname(__file__), "pipelines")


def loads(text: str, properties: dict[str, str] | None = None) -> dict:
    """JSON with comments, bare keys, missing outer braces, trailing commas and ${name}, which properties give."""
    properties = properties or {}

    def value(m: re.Match) -> str:
        if m[1] not in properties:
            raise ValueError(f"property {m[1]!r} isn't given")
        return json.dumps(properties[m[1]])

    strings: list[str] = []

    def put_away(m: re.Match) -> str:
        strings.append(m[0])
        return f"\x00{len(strings) - 1}\x00"

    text = re.sub(r'"(?:[^"\\]|\\.)*"', put_away, text)
    text = re.sub(r"(?:#|//)[^\n]*", "", text)
    text = re.sub(r"\$\{(\w+)\}", value, text)
    text = re.sub(r'"(?:[^"\\]|\\.)*"', put_away, text)
    text = re.sub(r"([A-Za-z_][\w.-]*)\s*[:=]", lambda m: put_away(re.match(r".*", f'"{m[1]}"')) + ":", text)
    text = re.sub(r"(\x00\d+\x00)\s*=", r"\1:", text)
    text = re.sub(r"(?<=[:\[,\s])(?!true\b|false\b|null\b)([A-Za-z_][\w./-]*)(?=\s*[,}\]\n]|$)", lambda m: put_away(re.match(r".*", f'"{m[1]}"')), text)
    text = re.sub(r",(\s*[}\]])", r"\1", text.strip())
    text = text if text.startswith("{") else "{" + text + "}"
    text = re.sub(r",(\s*[}\]])", r"\1", text)
    return json.loads(re.sub(r"\x00(\d+)\x00", lambda m: strings[int(m[1])], text))


def find(name: str) -> str:
    """The text of a configuration: a file, or one of the shipped pipelines."""
    for path in (name, os.path.join(_HERE, name)):
        if os.path.isfile(path):
            with open(path, encoding="utf-8") as f:
                return f.read()
    raise ValueError(f"no pipeline {name!r} here or among {sorted(os.listdir(_HERE))}")


class Pipeline:
    def __init__(self, steps: list[filters.Filter]):
        self.steps = steps

    @classmethod
    def of(cls, config: str | dict, properties: dict[str, str] | None = None) -> Pipeline:
        """From a parsed configuration or the name of one."""
        parsed = loads(find(config), properties) if isinstance(config, str) else config
        return cls([filters.make(step.pop("class"), **step) for step in map(dict, parsed["filters"])])

    def __call__(self, docs: DataFrame) -> DataFrame:
        """docs with `paragraphs` and `removed_by`, marked; the first filter that removes a document names it."""
        for step in self.steps:
            docs = step.apply(docs)
        return docs
