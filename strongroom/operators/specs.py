"""Metadata of vault entities.  One small spec per hub, link or satellite
drives one generic loader per operator, so no loader code is written per
table (the audit columns and naming suffixes are the same everywhere)."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed audit column names.
LOAD_DTS = "LOAD_DTS"
REC_SRC = "REC_SRC"
HASH_DIFF = "HASH_DIFF"
SNAPSHOT_DTS = "SNAPSHOT_DTS"

#: Column of a *placed* feed or table: what stands before the first delimiter of its key
#: texts (``hashing.place_of``), by which its rows lie together.  Rows of one key
#: have one place, so loads and joins that take it along need no shuffle of their own.
PLACE = "_PLACE"


@dataclass(frozen=True)
class HubSpec:
    """A hub: ``hk`` is the hash-key column, ``bk`` the business-key columns
    of the staged feed, in recipe order.  ``collision_source`` adds REC_SRC to
    the key when two systems use equal values for different things (H3)."""

    name: str
    hk: str
    bk: tuple[str, ...]
    collision_source: bool = False
    algo: str = "sha256"

    def key_parts(self) -> tuple[str, ...]:
        return self.bk + ((REC_SRC,) if self.collision_source else ())


@dataclass(frozen=True)
class LinkSpec:
    """A link: ``refs`` lists (hub hash-key column, business-key columns of the
    staged feed) in the fixed recipe order; the link key hashes all of them."""

    name: str
    hk: str
    refs: tuple[tuple[str, tuple[str, ...]], ...]
    payload: tuple[str, ...] = ()
    algo: str = "sha256"

    def key_parts(self) -> tuple[str, ...]:
        out: list[str] = []
        for _, bks in self.refs:
            out.extend(bks)
        return tuple(out)


@dataclass(frozen=True)
class SatSpec:
    """A satellite of one parent.  ``parent_bk`` recomputes the parent hash
    key from the staged business keys; when empty the staged feed already
    carries ``parent_hk``.  ``ssqn`` makes it multi-active (PK gets SSQN)."""

    name: str
    parent_hk: str
    payload: tuple[str, ...]
    parent_bk: tuple[str, ...] = ()
    hashdiff_cols: tuple[str, ...] | None = None
    ssqn: str | None = None
    algo: str = "sha256"
    strict_hashdiff: bool = False
    extra: tuple[str, ...] = field(default=())

    def diff_cols(self) -> tuple[str, ...]:
        return self.hashdiff_cols if self.hashdiff_cols is not None else self.payload

    def part_keys(self) -> list[str]:
        return [self.parent_hk] + ([self.ssqn] if self.ssqn else [])

    def pk(self) -> list[str]:
        return self.part_keys() + [LOAD_DTS]
