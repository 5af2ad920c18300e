"""Column protection: AES encryption, role-based masking and row filters, PII tags.

Policies are plain Python data evaluated into Spark expressions.  A policy names
the roles it knows; any other role is refused.  Tags live in column metadata.
Spark drops metadata on computed expressions, so :func:`lineage_tags` follows
the attribute references of the analysed plan from every output column back to
the tagged ones, into the plans of subqueries too (a scalar's value, and the
columns that an IN or EXISTS subquery compares); a column whose origin the plan
does not show (the output of foreign code, say) counts as carrying every tag.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TAG_KEY = "tags"


class AccessDenied(PermissionError):
    pass


def aes_encrypt_b64(col: str | Column, key: str, mode: str = "ECB", padding: str = "PKCS") -> Column:
    """``base64(aes_encrypt(col, key, mode, padding))``; ECB/PKCS is deterministic, GCM (Spark's default) is not."""
    c = F.col(col) if isinstance(col, str) else col
    return F.base64(F.aes_encrypt(c, F.lit(key), F.lit(mode), F.lit(padding)))


def aes_decrypt_b64(col: str | Column, key: str, mode: str = "ECB", padding: str = "PKCS") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.aes_decrypt(F.unbase64(c), F.lit(key), F.lit(mode), F.lit(padding)).cast("string")


def encrypt_distinct(df: DataFrame, col: str, key: str, out: str = "description_crypt") -> DataFrame:
    """Distinct non-NULL values of ``col`` (an aggregate: partial per partition, then merged), encrypted."""
    distinct = df.where(F.col(col).isNotNull()).select(col).distinct()
    return distinct.select(aes_encrypt_b64(col, key).alias(out), F.col(col))


@dataclass
class Policy:
    """Per-role masking (column → 'hash' | 'null' | 'redact'), row filters, and denied tags."""
    masks: dict[str, dict[str, str]] = field(default_factory=dict)
    row_filters: dict[str, str] = field(default_factory=dict)   # role → SQL predicate
    denied_tags: dict[str, set[str]] = field(default_factory=dict)
    open_roles: set[str] = field(default_factory=set)           # roles that see everything

    def check(self, role: str) -> None:
        if role not in self.open_roles | self.masks.keys() | self.row_filters.keys() | self.denied_tags.keys():
            raise AccessDenied(f"unknown role {role}")


def _mask(c: str, how: str) -> Column:
    if how == "hash":
        return F.sha2(F.col(c).cast("string"), 256)
    if how == "null":
        return F.lit(None).cast("string")
    if how == "redact":
        return F.regexp_replace(F.col(c).cast("string"), r"[\p{L}\p{M}\p{N}]", "x")
    raise ValueError(how)


def apply_masks(df: DataFrame, policy: Policy, role: str) -> DataFrame:
    policy.check(role)
    masks = policy.masks.get(role, {})
    return df.select(*[_mask(c, masks[c]).alias(c) if c in masks else F.col(c) for c in df.columns])


def apply_row_filter(df: DataFrame, policy: Policy, role: str) -> DataFrame:
    policy.check(role)
    cond = policy.row_filters.get(role)
    return df.where(F.expr(cond)) if cond is not None else df


# --------------------------------------------------------------------------- tags


def tag(df: DataFrame, columns: dict[str, set[str]]) -> DataFrame:
    """Attach tags (e.g. ``{"c_name": {"PII"}}``) to columns as metadata."""
    out = []
    for c in df.columns:
        if c in columns:
            md = dict(df.schema[c].metadata)
            md[TAG_KEY] = sorted(set(md.get(TAG_KEY, [])) | set(columns[c]))
            out.append(F.col(c).alias(c, metadata=md))
        else:
            out.append(F.col(c))
    return df.select(*out)


def tags_of(df: DataFrame) -> dict[str, set[str]]:
    return {f.name: set(f.metadata.get(TAG_KEY, [])) for f in df.schema.fields if f.metadata.get(TAG_KEY)}


EVERY_TAG = "*"
SUBQUERY = {"ScalarSubquery", "ListQuery", "Exists", "LateralSubquery"}  # expressions that hold a plan


def _seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def lineage_tags(df: DataFrame) -> dict[str, set[str]]:
    """Tags of every output column, those of all columns it is computed from included."""
    own: dict[int, set[str]] = {}      # expression id -> tags in its metadata
    inputs: dict[int, set[int]] = {}   # expression id -> ids it is computed from

    def note(e) -> int:
        i = e.exprId().id()
        inputs.setdefault(i, set())
        if e.metadata().contains(TAG_KEY):
            own.setdefault(i, set()).update(e.metadata().getStringArray(TAG_KEY))
        return i

    def refs(e) -> set[int]:
        return {a.exprId().id() for a in _seq(e.references().toSeq())} | subqueries(e)

    def subqueries(e) -> set[int]:
        """What the plans inside an expression give it: their output, and for IN and EXISTS all that decides about their rows."""
        out: set[int] = set()
        for c in _seq(e.children()):
            out |= subqueries(c)
        if e.getClass().getSimpleName() in SUBQUERY:
            plan = e.plan()
            walk(plan)
            out |= {a.exprId().id() for a in _seq(plan.output())} | conditions(plan)
        return out

    def conditions(p) -> set[int]:
        out = {a.exprId().id() for a in _seq(p.references().toSeq())} if p.getClass().getSimpleName() in ("Filter", "Join") else set()
        return out.union(*[conditions(c) for c in _seq(p.children())])

    def aliases(e) -> None:
        if e.getClass().getSimpleName() == "Alias":
            inputs.setdefault(note(e), set()).update(refs(e))
        for c in _seq(e.children()):
            aliases(c)

    def walk(p) -> None:
        kind, children = p.getClass().getSimpleName(), _seq(p.children())
        for c in children:
            walk(c)
        for e in _seq(p.expressions()):
            aliases(e)
        if not children:
            for a in _seq(p.output()):
                note(a)
        elif kind == "Union":
            for c in children:
                for a, b in zip(_seq(p.output()), _seq(c.output())):
                    inputs.setdefault(note(a), set()).add(b.exprId().id())
        elif kind == "Generate":
            for a in _seq(p.generatorOutput()):
                inputs.setdefault(note(a), set()).update(refs(p.generator()))

    plan = df._jdf.queryExecution().analyzed()
    walk(plan)
    out: dict[str, set[str]] = {}
    for a in _seq(plan.output()):
        todo, seen, tags = [a.exprId().id()], set(), set()
        while todo:
            i = todo.pop()
            if i in seen:
                continue
            seen.add(i)
            tags |= own.get(i, set()) if i in inputs else {EVERY_TAG}
            todo += inputs.get(i, ())
        if tags:
            out.setdefault(a.name(), set()).update(tags)
    return out


def enforce_tags(df: DataFrame, policy: Policy, role: str, requested: list[str] | None = None) -> DataFrame:
    """Drop columns whose tags the role may not see; raise if one of them was asked for by name."""
    policy.check(role)
    denied = policy.denied_tags.get(role, set())
    blocked = [c for c, t in lineage_tags(df).items() if denied and (t & denied or EVERY_TAG in t)]
    if requested:
        asked = [c for c in requested if c in blocked]
        if asked:
            raise AccessDenied(f"role {role} may not read {', '.join(asked)}")
    return df.select(*[c for c in df.columns if c not in blocked])
