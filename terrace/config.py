"""The build's configuration, read strictly from TOML."""

from __future__ import annotations

import tomllib
from dataclasses import dataclass, field
from pathlib import Path

from terrace.operators.graph import Property, Resolution
from terrace.operators.ranking import Bucket, normalised


@dataclass
class Config:
    name: str
    work: Path
    out: Path
    tiers: list[int]
    resource: str
    ontology: str
    sources: dict[str, str]
    sha256: dict[str, str]
    pageviews: list[str]
    site: str
    methods: list[str]
    languages: list[str]
    buckets: list[Bucket]
    roots: list[tuple[str, str, int]]
    groups: dict[str, str]
    min_chars: int
    skip_prefixes: list[str]
    target: list[str]
    country_class: str
    country_map: str | None
    walk: list[str]
    hops: int
    rules: Resolution
    min_editions: int
    weights: dict[str, float]
    floors: dict[str, int]
    literals: dict[str, tuple[str, str]]
    objects: dict[str, str]
    dims: int
    chars_per_token: float
    price: float
    label_languages: list[str]
    drop_non_ascii: bool
    drop_external: bool
    allowed: list[tuple[str, str]] = field(default_factory=list)
    share_tolerance: float = 0.01
    provider: str = "seeded"
    licence: str = "cc-by-sa-3.0"
    attribution: str = ""
    text: str = field(default="", repr=False)


def load_config(path: str) -> Config:
    """Raises ValueError on tiers that do not ascend, repeated buckets, shares that sum to 0, or unknown inheritance."""
    text = Path(path).read_text()
    raw = tomllib.loads(text)
    base = Path(path).resolve().parent
    data = raw["dataset"]
    tiers = data["tiers"]
    if not tiers or tiers != sorted(set(tiers)):
        raise ValueError("tiers must ascend")
    onto, res = raw["namespaces"]["ontology"], raw["namespaces"]["resource"]
    listed = raw["buckets"]
    buckets = normalised([Bucket(b["name"], float(b["share"])) for b in listed])
    geo, rank, props, emb, tbox = raw["geography"], raw["ranking"], raw["properties"], raw.get("embedding", {}), raw.get("tbox", {})
    rules = Resolution({g: [Property(onto + p["property"], tuple(p.get("inherit", ()))) for p in ps] for g, ps in geo["resolution"].items()})
    for g, ps in rules.groups.items():
        for p in ps:
            if unknown := set(p.inherit) - set(rules.groups):
                raise ValueError(f"{g} inherits from unknown groups {sorted(unknown)}")
    groups = {b["name"]: b["group"] for b in listed}
    allowed = []
    for p in [*props.get("literals", []), *props.get("objects", [])]:
        of = p.get("groups", sorted(set(groups.values())))
        if unknown := set(of) - set(groups.values()):
            raise ValueError(f"property {p['property']} of unknown groups {sorted(unknown)}")
        allowed += [(g, onto + p["property"]) for g in of]
    views = raw.get("pageviews", {})
    where = lambda p: p if "://" in p else (base / p).as_uri()
    return Config(
        name=data["name"], work=base / data.get("work", "work"), out=base / data.get("out", "out"), tiers=tiers, resource=res, ontology=onto,
        sources={k: where(v) for k, v in raw["sources"].items()}, sha256=raw.get("sha256", {}), pageviews=[where(p) for p in views.get("files", [])],
        site=views.get("site", "wiki"), methods=views.get("methods", []), languages=views.get("languages", ["en"]), buckets=buckets,
        roots=[(onto + r, b["name"], i) for i, b in enumerate(listed) for r in b["roots"]], groups=groups, allowed=allowed, share_tolerance=float(raw.get("validate", {}).get("share_tolerance", 0.01)),
        provider=emb.get("provider", "seeded"), licence=data.get("licence", "cc-by-sa-3.0"), attribution=data.get("attribution", ""),
        min_chars=raw["candidates"]["min_chars"], skip_prefixes=raw["candidates"].get("skip_prefixes", []), target=[res + c for c in geo["target"]],
        country_class=onto + geo.get("country_class", "Country"), country_map=str(base / geo["country_map"]) if "country_map" in geo else None,
        walk=[onto + p for p in geo["walk"]], hops=geo.get("hops", 3), rules=rules, min_editions=geo.get("min_editions", 4),
        weights={k: float(v) for k, v in rank["weights"].items()}, floors={k: int(v) for k, v in rank["floors"].items()},
        literals={onto + p["property"]: (p["column"], p["type"]) for p in props.get("literals", [])}, objects={onto + p["property"]: f"{p['column']}_label" for p in props.get("objects", [])},
        dims=emb.get("dims", 64), chars_per_token=emb.get("chars_per_token", 4.06), price=emb.get("price_per_million", 0.02), text=text,
        label_languages=tbox.get("label_languages", ["en"]), drop_non_ascii=tbox.get("drop_non_ascii", True), drop_external=tbox.get("drop_external", True),
    )
