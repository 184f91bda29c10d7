"""The settings of a segmentation run, as a table of fields; one function reads values by it, one checks them, and older forms
are rules that say which fields they set.

A field has a default, whose type is the field's, and may have a rule that its value must meet. What depends on several fields
or on the image is a check of the whole."""

from __future__ import annotations

import json
import shlex
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from types import SimpleNamespace

from ..functions.models import MODELS

SKIP, EXPANSION = "skip", "expand:"
TRUE = {"1", "true", "yes", "on"}
SLOTS = range(1, 5)

TARGETS = {f"{family}:{name}": targets for family, names, targets, _, _ in MODELS for name in names}
DIMENSIONS = {f"{family}:{name}": dims for family, names, _, dims, _ in MODELS for name in names}


def models_for(target: str) -> list[str]:
    return [m for m, targets in TARGETS.items() if target in targets]


# The models that a foci slot may name.
FOCI_MODELS = [m for m in TARGETS if m.startswith(("spotiflow:", "stardist:SD_Foci")) or m in ("cellpose3:bact_phase_cp3", "cellpose3:bact_fluor_cp3")]


@dataclass(frozen=True)
class Field:
    default: object
    rule: Callable[[object], bool] | None = None
    must: str = ""

    def read(self, value: object) -> object:
        kind = type(self.default)
        return str(value).strip().lower() in TRUE if kind is bool else kind(value)


def one_of(*values: str) -> dict:
    return {"rule": lambda v: v in values, "must": f"must be one of {', '.join(values)}"}


NOT_NEGATIVE = {"rule": lambda v: v >= 0, "must": "must be zero or more"}
FROM_ONE = {"rule": lambda v: v >= 1, "must": "must be one or more"}
FOCI = {"rule": lambda v: v == SKIP or v in FOCI_MODELS, "must": "must be a foci model or skip"}

# The fields' names and defaults.
FIELDS = {
    "model": Field("cellpose3:nuclei", lambda v: v in TARGETS, "must be a known model"),
    "target": Field("nuclei", **one_of("nuclei", "cells", "foci", "spots")),
    "primary_channel": Field(1, **FROM_ONE),
    "nuclei_channel": Field(0, **NOT_NEGATIVE),
    "device": Field("auto", **one_of("auto", "cpu", "cuda")),
    "dimension_mode": Field("auto", **one_of("auto", "2d", "3d")),
    "diameter": Field(0.0),
    "cellprob_threshold": Field(0.0),
    "flow_threshold": Field(0.4),
    "stardist_prob_threshold": Field(-1.0),
    "stardist_nms_threshold": Field(-1.0),
    "smooth_stardist_labels": Field(True),
    "spotiflow_prob_threshold": Field(-1.0),
    "spotiflow_min_distance": Field(1.0, **NOT_NEGATIVE),
    "spotiflow_local_refinement": Field(False),
    "benchmark": Field(False),
    "cell_model": Field("cellpose3:cyto3", lambda v: v == SKIP or v in models_for("cells") or v.removeprefix(EXPANSION) in models_for("nuclei") and v.startswith(EXPANSION), "must be a cell model, an expansion of a nucleus model, or skip"),
    "cell_channel": Field(1, **FROM_ONE),
    "cell_nuclei_channel": Field(0, **NOT_NEGATIVE),
    "cell_expansion_distance": Field(10.0, **NOT_NEGATIVE),
    "nucleus_model": Field(SKIP, lambda v: v == SKIP or v in models_for("nuclei"), "must be a nucleus model or skip"),
    "nucleus_channel": Field(1, **FROM_ONE),
    **{name: field for k in SLOTS for name, field in ((f"foci_model_{k}", Field(SKIP, **FOCI)), (f"foci_channel_{k}", Field(1, **FROM_ONE)))},
    "include_original_channels": Field(False),
    "write_ome_zarr_labels": Field(True),
    "measurements_database": Field("duckdb", **one_of("duckdb", "sqlite", SKIP)),
    "remove_border_cells": Field(True),
    "labels_log_info": Field(False),
}


class Settings(SimpleNamespace):
    """A value for each field; those not given have their defaults."""

    def __init__(self, **values):
        if unknown := values.keys() - FIELDS.keys():
            raise TypeError(f"no such settings: {sorted(unknown)}")
        super().__init__(**{name: values.get(name, field.default) for name, field in FIELDS.items()})

    @classmethod
    def of(cls, values: Mapping) -> Settings:
        """From names and values of any form, older ones too; names that aren't fields are left out."""
        return cls(**{name: FIELDS[name].read(v) for name, v in translated(values).items() if name in FIELDS})

    def values(self) -> dict:
        return {name: getattr(self, name) for name in FIELDS}

    @property
    def foci(self) -> list[tuple[int, str, int]]:
        """(slot, model, channel) of the slots in use."""
        return [(k, m, getattr(self, f"foci_channel_{k}")) for k in SLOTS if (m := getattr(self, f"foci_model_{k}")) != SKIP]

    @property
    def seed_model(self) -> str | None:
        """The nucleus model whose labels grow to cells, if cells are made that way."""
        grown = self.cell_model.startswith(EXPANSION)
        return self.cell_model.removeprefix(EXPANSION) if grown else None

    @property
    def seed_channel(self) -> int:
        second = self.cell_nuclei_channel
        return second if second > 1 else self.cell_channel

    def used_channels(self) -> Iterable[tuple[str, int]]:
        """(what for, channel) of the steps in use."""
        if self.cell_model != SKIP:
            yield "cells", self.seed_channel if self.seed_model else self.cell_channel
            if self.cell_nuclei_channel and not self.seed_model:
                yield "the nuclei of cells", self.cell_nuclei_channel
        if self.nucleus_model != SKIP:
            yield "nuclei", self.nucleus_channel
        for k, _, channel in self.foci:
            yield f"foci of slot {k}", channel

    def check(self, channels: int | None = None) -> None:
        """ValueError at the first field, or combination of them, that is wrong; with the image's number of channels those too."""
        for name, field in FIELDS.items():
            if field.rule and not field.rule(getattr(self, name)):
                raise ValueError(f"{name} {field.must}, and is {getattr(self, name)!r}")
        if self.cell_model == self.nucleus_model == SKIP and not self.foci:
            raise ValueError("select a step: cells, nuclei or foci")
        if self.spotiflow_local_refinement and (wide := [m for _, m, _ in self.foci if m.startswith("spotiflow:") and DIMENSIONS[m] == "3d"]) and self.dimension_mode != "2d":
            raise ValueError(f"{wide[0]} finds points in whole volumes, which can't be refined plane by plane")
        for what, channel in self.used_channels() if channels is not None else ():
            if not 1 <= channel <= channels:
                raise ValueError(f"channel {channel} for {what} is outside 1 to {channels}")


def selected_channels(primary: int, nuclei: int, count: int) -> list[int]:
    """Zero-based channels of a model: the primary, and the nuclei's if it is another."""
    wanted = dict.fromkeys([primary, *([nuclei] if nuclei > 0 else [])])
    if outside := [c for c in wanted if c not in range(1, count + 1)]:
        raise ValueError(f"channels {outside} are outside 1 to {count}")
    return [c - 1 for c in wanted]


NUCLEI, SPOTS = "cellpose3:nuclei", "spotiflow:general"
# Names of the older forms, with a switch for each step.
RENAMED = {"spotiflow_microsam_refinement": "spotiflow_local_refinement"}
OLDER = ["cell_step", "cell_method", "cell_nuclei_model", "cell_expansion_nucleus_model", "nucleus_step", *(f"foci_step_{k}" for k in SLOTS)]
METHODS = ("deep-learning", "cell-expansion")


@dataclass(frozen=True)
class Rule:
    """An older form's meaning: where `when` holds of it, `sets` says what the fields are; with `unless` a given field stays."""

    when: Callable[[SimpleNamespace], object]
    sets: Callable[[SimpleNamespace], dict]
    unless: bool = False


def _older_form(values: Mapping) -> SimpleNamespace:
    on = lambda name, default: Field(False).read(values.get(name, default))
    method = values.get("cell_method", METHODS[0])
    if method not in METHODS:
        raise ValueError(f"cell_method must be one of {', '.join(METHODS)}, and is {method!r}")
    channel = int(values.get("cell_nuclei_channel", 1))
    cells, nuclei = on("cell_step", True), on("nucleus_step", False)
    return SimpleNamespace(given=values, cells=cells, grown=method == METHODS[1], nuclei=nuclei, channel=channel, by_cells=cells and method == METHODS[0] and channel > 0 and not nuclei, slots={k: on(f"foci_step_{k}", False) for k in SLOTS if f"foci_step_{k}" in values})


RULES = [
    Rule(lambda o: not o.cells, lambda o: {"cell_model": SKIP}),
    Rule(lambda o: o.cells and o.grown, lambda o: {"cell_model": EXPANSION + o.given.get("cell_expansion_nucleus_model", NUCLEI)}),
    Rule(lambda o: o.by_cells, lambda o: {"nucleus_model": o.given.get("cell_nuclei_model", NUCLEI), "nucleus_channel": o.channel}),
    Rule(lambda o: o.nuclei, lambda o: {"nucleus_model": NUCLEI}, unless=True),
    Rule(lambda o: not o.nuclei and not o.by_cells and "nucleus_step" in o.given, lambda o: {"nucleus_model": SKIP}),
    Rule(lambda o: o.slots, lambda o: {f"foci_model_{k}": SPOTS for k, on in o.slots.items() if on}, unless=True),
    Rule(lambda o: o.slots, lambda o: {f"foci_model_{k}": SKIP for k, on in o.slots.items() if not on}),
]


def translated(values: Mapping) -> dict:
    """The values in today's names, without the older ones."""
    out = {name: v for name, v in values.items() if name not in RENAMED and name not in OLDER}
    for old, new in RENAMED.items():
        if old in values:
            out.setdefault(new, values[old])
    if any(name in values for name in OLDER):
        form = _older_form(values)
        for rule in (r for r in RULES if r.when(form)):
            found = rule.sets(form)
            out |= {name: v for name, v in found.items() if not (rule.unless and name in out)}
    return out


def model_names(value: object) -> list[str]:
    """Names from a list, a JSON array, or text separated by , or ;."""
    if isinstance(value, str):
        try:
            found = json.loads(value) if value.strip().startswith("[") else None
        except ValueError:
            found = None
        value = found if found is not None else value.replace(";", ",").split(",")
    return [name for name in (str(part).strip() for part in value or ()) if name]


# A configuration document: what a run may be asked, for forms and command lines ---------------------------------------------

# What a document must hold, its sections of items, and what items of each must have.
REQUIRED = ["citations", "docker_image", "algorithm_folder_name", "exec_function", "inputs", "outputs", "parameters", "display_only"]
SECTIONS = {"inputs": ("name", "cli_tag"), "outputs": ("name",), "parameters": ("name", "cli_tag")}
# What a parameter's kind is called.
KINDS = {bool: "checkbox", int: "integer", float: "float", str: "textbox"}


def configuration(command: str = "segment") -> dict:
    """A document whose parameters are the fields."""
    parameters = [{"name": n, "type": KINDS[type(f.default)], "default": f.default, "cli_order": k, "cli_tag": "--" + n.replace("_", "-"), "append_value": True} for k, (n, f) in enumerate(FIELDS.items(), 1)]
    return dict.fromkeys(REQUIRED) | {"exec_function": {"cli_command": command}, "inputs": [], "outputs": [], "parameters": parameters}


def read_configuration(path: str) -> dict:
    """A document from a file of JSON, or of YAML where its library is installed; ValueError if it isn't a mapping."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        document = json.loads(text)
    except ValueError:
        import yaml

        document = yaml.safe_load(text)
    if not isinstance(document, dict):
        raise ValueError(f"{path} holds no mapping")
    return document


def configuration_errors(document: Mapping) -> list[str]:
    """What a document lacks."""
    items = [(f"{section}[{k}]", part, item if isinstance(item, Mapping) else {}) for section, part in SECTIONS.items() for k, item in enumerate(document.get(section) or [])]
    return [f"{key} is missing" for key in REQUIRED if key not in document] + [f"{place} has no {need}" for place, needs, item in items for need in needs if not item.get(need)]


def words_of(item: Mapping, values: Mapping) -> list[str]:
    """An item's part of a command line. A value of its own goes before its `value`, and that before its `default`; nothing and
    empty text have no words, and a checkbox is its tag alone unless its value is to be appended too."""
    given = next((source[key] for source, key in ((values, item.get("name")), (item, "value"), (item, "default")) if key in source), None)
    with_value = item.get("append_value", item.get("type") != "checkbox")
    said = given not in (None, "") and (given is not False or (item.get("type") == "checkbox" and item.get("append_value")))
    if not item.get("cli_tag") or not said:
        return []
    text = ",".join(map(str, given)) if isinstance(given, list) else str(given)
    return [str(item["cli_tag"]), *([text] if with_value else [])]


def command_line(document: Mapping, values: Mapping) -> str:
    """The command that a document makes of values, its items by their order, hidden ones among them."""
    run = document["exec_function"]
    items = [i for part in (*(document.get(s) for s in SECTIONS), run.get("hidden_args")) for i in part or ()]
    ordered = sorted(items, key=lambda i: int(i.get("cli_order", 0)))
    return shlex.join([*shlex.split(str(run["cli_command"])), *(w for i in ordered for w in words_of(i, values))])
