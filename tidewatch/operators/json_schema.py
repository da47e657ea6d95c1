"""JSON Schema documents (draft 7) as Spark expressions over VARIANT.

``Schema`` turns a document into the findings of a value, and into an expression of whether it is valid. The schema is unrolled when the
plan is made. For findings, a value becomes a row, and so does each item of its lists and each member that is looked up by a name found in the
value; lists in lists of any depth need no shuffle. Members of known names are reached by their path in such a row, so its rules are one flat
array that Spark compiles. A finding in the scan is the number of its rule, the list indexes on its way and the value; path and message are made
of it afterwards, for broken rules only. The test of validity opens objects as maps and lists by higher-order functions, and stops early.
The expressions are built as SQL text, which Spark parses at once.

Keywords: type, enum, const, properties, required, additionalProperties, patternProperties, minProperties, maxProperties, items, minItems, maxItems,
minLength, maxLength, pattern, minimum, maximum, exclusiveMinimum, exclusiveMaximum, multipleOf, format (``date-time``, on request), allOf,
anyOf, oneOf, not, if/then/else, references inside the document, and true/false as schemas. Annotations are skipped. Any other keyword
is an error when the expressions are made, as are a reference that leads back to itself, a list under ``items`` and objects under ``enum``.
Values that are objects or lists appear in messages as JSON, numbers without trailing zeros.
"""

from __future__ import annotations

import json as js
import re
from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ANNOTATIONS = {"$schema", "$id", "$comment", "title", "description", "default", "examples", "definitions", "$defs", "readOnly", "writeOnly"}
KEYWORDS = {
    "type", "enum", "const", "properties", "required", "additionalProperties", "patternProperties", "minProperties", "maxProperties", "items", "minItems", "maxItems",
    "minLength", "maxLength", "pattern", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf", "format", "allOf", "anyOf", "oneOf", "not", "if", "then", "else", "$ref",
}
ON_MEMBERS = {"properties", "required", "additionalProperties", "patternProperties", "minProperties", "maxProperties"}
ON_ITEMS = {"items", "minItems", "maxItems"}
NO_PLACES = "CAST(array() AS array<struct<_level:int,_at:array<string>,_value:variant>>)"
NO_FINDING = "CAST(NULL AS struct<rule:int,value:variant,names:array<string>>)"
#: Stands for the value of a row in the SQL of its rules.
BASE = "\0"
_RULES = "array<struct<path:array<string>,steps:array<array<string>>,index:array<boolean>,keyword:string,form:string,head:string,one:string,many:string,whole:boolean>>"
#: Digits of a list index in the steps that findings are sorted by.
_INDEX = 10

Step = tuple[str, bool]  # a member's name, or ``#`` (an index) or ``*`` (a name) that is found in the value


def read_schema(spark: SparkSession, path: str) -> dict:
    """The schema document in a file of any file system that Spark reads."""
    return js.loads(spark.read.text(path, wholetext=True).first()[0])


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _names(names) -> str:
    return f"CAST(array({', '.join(map(literal, names))}) AS array<string>)"


def kind_of(value: str) -> str:
    """The JSON type of a value; all type names of VARIANT but these are numbers."""
    kinds = "'STRING', 'string', 'VOID', 'null', 'OBJECT', 'object', 'ARRAY', 'array', 'BOOLEAN', 'boolean'"
    return f"coalesce(try_element_at(map({kinds}), substring_index(schema_of_variant({value}), '<', 1)), 'number')"


def members(value: str) -> str:
    """The members of an object, null for other values."""
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def items_of(value: str) -> str:
    """The items of a list, null for other values."""
    return f"try_variant_get({value}, '$', 'array<variant>')"


def reach(value: str, names: tuple[str, ...], form: str = "variant") -> str:
    """The member at the end of the names, null where one of them is missing or it has another form."""
    if names and not all(re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", n) for n in names):
        value, names = f"try_element_at({reach(value, names[:-1], 'map<string,variant>')}, {literal(names[-1])})", ()
    return value if not names and form == "variant" else f"try_variant_get({value}, '$.{'.'.join(names)}', '{form}')".replace("$.'", "$'")


def quote(text: Column) -> Column:
    double = text.contains("'") & ~text.contains('"')
    return F.when(double, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(text, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _as_list(x) -> list:
    return [] if x is None else [x] if isinstance(x, str) else list(x)


class _Value:
    """The SQL of a value, its type, members and items, each of them computed once before."""

    def __init__(self, value: str, kind: str | None, members: str, items: str):
        self.value, self.members, self.items = value, members, items
        self.kind = kind or kind_of(value)
        self.text = f"CASE WHEN {self.kind} = 'string' THEN try_variant_get({value}, '$', 'string') END"
        self.number = f"CASE WHEN {self.kind} = 'number' THEN try_variant_get({value}, '$', 'double') END"


class _Reached(_Value):
    """A value by its path; all of it is null where the value is missing."""

    def __init__(self, names: tuple[str, ...]):
        value = reach(BASE, names)
        super().__init__(value, f"CASE WHEN {value} IS NOT NULL THEN {kind_of(value)} END", reach(BASE, names, "map<string,variant>"), reach(BASE, names, "array<variant>"))


class Schema:
    """A schema document as expressions, and the rules that findings name by number."""

    def __init__(self, document: dict | bool, strict_formats: bool = False):
        self.document, self.strict = document, strict_formats
        self.rules: list[dict] = []
        self._fresh = count()

    def findings(self, df: DataFrame, value: str, keys: list[str], whole: list[str] | None = None) -> DataFrame:
        """A row per finding of the VARIANT column ``value``, none for null: the key columns, ``_f`` for ``described``, and its place ``_i`` among the findings of a path.

        ``whole`` has entries (null: no finding) on the value as a whole, whose SQL names it by ``BASE``; theirs are found for null too.
        """
        self._slots, self._children = [[]], [[]]
        self._gather(self.document, (), (), (), 0, None)
        base = [f"CASE WHEN _level = {n} THEN _value END" for n in range(len(self._slots))]
        top = [f"CASE WHEN _level = 0 THEN {e.replace(BASE, base[0])} END" for e in whole or []]
        rules = [*top, *(e.replace(BASE, base[n]) for n, slots in enumerate(self._slots) for e in slots)] or [NO_FINDING]
        places = df.select(*keys, F.expr(f"inline({self._places(0, value, ())})"))
        # one array, so that the rules are compiled together and share what they read;
        # before a plain explode Spark would evaluate it a second time, to drop empty arrays
        each = places.select(*keys, "_at", F.expr(f"array({', '.join(rules)})").alias("_rules")).select(*keys, "_at", F.posexplode_outer("_rules").alias("_p", "_e"))
        place = F.struct(F.col("_e.rule").alias("rule"), F.col("_p").alias("i"))
        finding = F.struct(F.col("_e.rule").alias("rule"), F.col("_at").alias("at"), F.col("_e.value").alias("value"), F.col("_e.names").alias("names"))
        return each.where(F.col("_e").isNotNull()).select(*keys, place.alias("_i"), finding.alias("_f"))

    def valid(self, value: str) -> Column:
        """Whether a value keeps the schema; null does."""
        return F.expr(f"coalesce({self._if_there(value, lambda x: self._valid(self.document, x, ()))}, true)")

    def add_rule(self, path: tuple[Step, ...], keyword: str, form: str, head: str = "", one: str = "", many: str | None = None, whole: bool = False) -> int:
        """A rule: its message is ``head``, the value (``shown``) or the names (``quoted``, ``plain``), and ``one`` or, for several names, ``many``."""
        texts, steps, index = ["" if path else "(root)"], [[]], []  # cut where a step is found in the value
        for at, (name, found) in enumerate(path):
            texts[-1] += ("." if at else "") + ("" if found else name)
            if found:
                texts.append("")
                steps.append([])
                index.append(name == "#")
            else:
                steps[-1].append(name)
        self.rules.append({"path": texts, "steps": steps, "index": index, "keyword": keyword, "form": form, "head": head, "one": one, "many": one if many is None else many, "whole": whole})
        return len(self.rules) - 1

    @staticmethod
    def entry(rule: int, value: str | None = None, names: str | None = None) -> str:
        return f"named_struct('rule', {rule}, 'value', {value or 'CAST(NULL AS VARIANT)'}, 'names', {names or 'CAST(NULL AS array<string>)'})"

    def described(self, finding: Column) -> list[Column]:
        """The columns steps, path, keyword, message and whole of a finding; steps sort list indexes by number."""
        rule = F.get(F.from_json(F.lit(js.dumps(self.rules)), _RULES), finding["rule"])
        value, names = finding["value"], finding["names"]
        plain, kind = F.to_json(value), F.substring_index(F.schema_of_variant(value), "<", 1)
        shown = F.when(kind == "STRING", quote(value.try_cast("string"))).when(kind == "VOID", F.lit("None")).when(kind == "BOOLEAN", F.initcap(plain)).otherwise(plain)
        form = rule["form"]
        middle = F.when(form == "shown", shown).when(form == "quoted", F.array_join(F.transform(names, quote), ", ")).when(form == "plain", F.array_join(names, ", ")).otherwise("")
        several = F.coalesce(F.size(names) > 1, F.lit(False))
        path, steps = F.get(rule["path"], 0), F.get(rule["steps"], 0)
        for k in range(max((len(r["index"]) for r in self.rules), default=0)):
            at = F.get(finding["at"], k)
            sorted_at = F.when(F.get(rule["index"], k), F.lpad(at, _INDEX, "0")).otherwise(at)
            path = F.concat(path, F.coalesce(F.concat(at, F.get(rule["path"], k + 1)), F.lit("")))
            steps = F.concat(steps, F.coalesce(F.concat(F.array(sorted_at), F.get(rule["steps"], k + 1)), F.array().cast("array<string>")))
        message = F.concat(rule["head"], middle, F.when(several, rule["many"]).otherwise(rule["one"]))
        return [steps.alias("_steps"), path.alias("path"), rule["keyword"].alias("keyword"), message.alias("message"), rule["whole"].alias("_whole")]

    # --- pieces of SQL

    def _name(self) -> str:
        return f"x{next(self._fresh)}"

    def _if_there(self, value: str, f: Callable[[str], str]) -> str:
        """The test ``f`` of a value that is computed once; true if it is missing."""
        x, y = self._name(), self._name()
        return f"forall(filter(array({value}), {y} -> {y} IS NOT NULL), {x} -> {f(x)})"

    def _opened(self, schema: dict, value: str, f: Callable[[_Value], str]) -> str:
        """An array of ``f`` alone, with type, members and items of the value computed once, as far as the schema asks for them."""
        kinds = _as_list(schema.get("type"))
        asks_kind = any(k not in ("object", "array") for k in kinds) or set(schema) & (KEYWORDS - ON_MEMBERS - ON_ITEMS - {"type", "allOf", "anyOf", "oneOf", "not", "if", "then", "else"})
        parts = {"v": value}
        if asks_kind:
            parts["k"] = kind_of(value)
        if set(schema) & ON_MEMBERS or "object" in kinds:
            parts["m"] = members(value)
        if set(schema) & ON_ITEMS or "array" in kinds:
            parts["a"] = items_of(value)
        x = self._name()
        own = _Value(f"{x}.v", f"{x}.k" if "k" in parts else None, f"{x}.m" if "m" in parts else "CAST(NULL AS map<string,variant>)", f"{x}.a" if "a" in parts else "CAST(NULL AS array<variant>)")
        fields = ", ".join(f"'{n}', {p}" for n, p in parts.items())
        return f"transform(array(named_struct({fields})), {x} -> {f(own)})"

    # --- the document

    def resolve(self, schema, trail: tuple[str, ...]) -> tuple[dict | bool, tuple[str, ...]]:
        """The schema that references lead to."""
        while isinstance(schema, dict) and "$ref" in schema:
            ref = schema["$ref"]
            if ref in trail:
                raise ValueError(f"the reference {ref} leads back to itself")
            if not ref.startswith("#"):
                raise ValueError(f"the reference {ref} leads out of the document")
            schema, trail = self.document, (*trail, ref)
            for step in filter(None, ref[1:].split("/")):
                step = step.replace("~1", "/").replace("~0", "~")
                schema = schema[int(step)] if isinstance(schema, list) else schema[step]
        if not isinstance(schema, (dict, bool)):
            raise ValueError("a list of schemas under items is not supported")
        if isinstance(schema, dict) and (unknown := set(schema) - ANNOTATIONS - KEYWORDS):
            raise ValueError(f"keywords without support: {', '.join(sorted(unknown))}")
        return schema, trail

    # --- rules of one value: keyword to (SQL of broken, form, head, one, many, SQL of names)

    def _rule(self, keyword: str, schema: dict, v: _Value) -> tuple | None:
        want = schema[keyword]

        def shown(broken: str, tail: str) -> tuple:
            return broken, "shown", "", tail, None, None

        if keyword == "type":
            kinds = _as_list(want)
            tests = [self._is(k, v) for k in kinds]
            return shown(f"NOT ({' OR '.join(tests)})", f" is not of type {', '.join(map(repr, kinds))}")
        if keyword == "enum":
            return shown(f"NOT ({self._among(v, want)})", f" is not one of {want!r}")
        if keyword == "const":
            return f"NOT ({self._among(v, [want])})", "text", f"{want!r} was expected", "", None, None
        if keyword == "additionalProperties" and want is False:
            extra = self._further(schema, v.members)
            patterns = schema.get("patternProperties")
            if patterns:
                tail = f" not match any of the regexes: {', '.join(map(repr, sorted(patterns)))}"
                return f"size({extra}) > 0", "quoted", "", " does" + tail, " do" + tail, f"array_sort({extra})"
            return f"size({extra}) > 0", "quoted", "Additional properties are not allowed (", " was unexpected)", " were unexpected)", f"array_sort({extra})"
        if keyword == "required":
            gone = f"array_except({_names(want)}, map_keys({v.members}))"
            return f"size({gone}) > 0", "each", "", " is a required property", None, gone
        if keyword in ("minProperties", "maxProperties"):
            less = keyword == "minProperties"
            tail = ("should be non-empty" if want == 1 else "does not have enough properties") if less else "has too many properties"
            return shown(f"{v.members} IS NOT NULL AND size({v.members}) {'<' if less else '>'} {want}", f" {tail}")
        if keyword in ("minItems", "maxItems", "minLength", "maxLength"):
            less, size = keyword.startswith("min"), f"size({v.items})" if keyword.endswith("Items") else f"length({v.text})"
            there = f"{v.items} IS NOT NULL AND " if keyword.endswith("Items") else ""
            tail = ("should be non-empty" if want == 1 else "is too short") if less else ("is expected to be empty" if want == 0 else "is too long")
            return shown(f"{there}{size} {'<' if less else '>'} {want}", f" {tail}")
        if keyword == "pattern":
            return shown(f"NOT rlike({v.text}, {literal(want)})", f" does not match {want!r}")
        if keyword in ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum"):
            less, strict = keyword.lower().endswith("minimum"), keyword.startswith("exclusive")
            sign = ("<" if less else ">") + "=" * strict
            return shown(f"{v.number} {sign} {float(want)!r}D", f" is {'less' if less else 'greater'} than {'or equal to ' * strict}the {'minimum' if less else 'maximum'} of {want!r}")
        if keyword == "multipleOf":
            return shown(f"({v.number}) / {float(want)!r}D <> round(({v.number}) / {float(want)!r}D)", f" is not a multiple of {want!r}")
        return None

    def _is(self, kind: str, v: _Value) -> str:
        if kind == "object":
            return f"{v.members} IS NOT NULL"
        if kind == "array":
            return f"{v.items} IS NOT NULL"
        if kind == "integer":
            return f"coalesce(({v.number}) = floor({v.number}), false)"
        return f"{v.kind} = {literal(kind)}"

    @staticmethod
    def _among(v: _Value, values: list) -> str:
        if any(isinstance(x, (dict, list)) for x in values):
            raise ValueError("enum and const of objects and lists are not supported")
        texts = [literal(x) for x in values if isinstance(x, str)]
        numbers = [f"{float(x)!r}D" for x in values if isinstance(x, (int, float)) and not isinstance(x, bool)]
        flags = [literal(js.dumps(x)) for x in values if isinstance(x, bool)]
        tests = ["false"]
        if texts:
            tests.append(f"coalesce(({v.text}) IN ({', '.join(texts)}), false)")
        if numbers:
            tests.append(f"coalesce(({v.number}) IN ({', '.join(numbers)}), false)")
        if None in values:
            tests.append(f"{v.kind} = 'null'")
        if flags:
            tests.append(f"({v.kind} = 'boolean' AND to_json({v.value}) IN ({', '.join(flags)}))")
        return " OR ".join(tests)

    def _further(self, schema: dict, m: str) -> str:
        """The names of members without a schema of their own."""
        names = f"array_except(map_keys({m}), {_names(schema.get('properties', {}))})"
        for pattern in schema.get("patternProperties", {}):
            n = self._name()
            names = f"filter({names}, {n} -> NOT rlike({n}, {literal(pattern)}))"
        return names

    def _like(self, pattern: str, m: str) -> str:
        n = self._name()
        return f"filter(map_keys({m}), {n} -> rlike({n}, {literal(pattern)}))"

    # --- findings

    def _gather(self, schema, names: tuple[str, ...], path: tuple[Step, ...], trail: tuple[str, ...], level: int, guard: str | None) -> None:
        """Adds the rules of the member ``names`` of a level's value to the entries of the level; they hold for it where ``guard`` does."""
        schema, trail = self.resolve(schema, trail)
        v = _Reached(names)
        there = f"{v.value} IS NOT NULL" + (f" AND {guard}" if guard else "")

        def slot(keyword: str, broken: str, form: str, head: str = "", one: str = "", many: str | None = None, found: str | None = None) -> None:
            entry = self.entry(self.add_rule(path, keyword, form, head, one, many), v.value if form == "shown" else None, found)
            self._slots[level].append(f"CASE WHEN {there} AND ({broken}) THEN {entry} END")

        if isinstance(schema, bool):
            if not schema:
                slot("false", "true", "shown", "False schema does not allow ")
            return
        for keyword, want in schema.items():
            if keyword == "required":
                rule = self.add_rule(path, keyword, "quoted", "", " is a required property")
                for n in dict.fromkeys(want):
                    gone = f"{there} AND {v.members} IS NOT NULL AND {reach(BASE, (*names, n))} IS NULL"
                    self._slots[level].append(f"CASE WHEN {gone} THEN {self.entry(rule, names=_names([n]))} END")
            elif found := self._rule(keyword, schema, v):
                broken, form, head, one, many, extra = found
                slot(keyword, broken, form, head, one, many, extra)
            elif keyword == "properties":
                for n, child in want.items():
                    self._gather(child, (*names, n), (*path, (n, False)), trail, level, guard)
            elif keyword == "additionalProperties" and isinstance(want, dict):
                self._below(want, self._further(schema, v.members), v, (*path, ("*", True)), trail, level, guard)
            elif keyword == "patternProperties":
                for pattern, child in want.items():
                    self._below(child, self._like(pattern, v.members), v, (*path, ("*", True)), trail, level, guard)
            elif keyword == "items":
                self._below(want, None, v, (*path, ("#", True)), trail, level, guard)
            elif keyword == "allOf":
                for child in want:
                    self._gather(child, names, path, trail, level, guard)
            elif keyword == "if":
                held = self._kept(want, names, trail)
                for k, test in (("then", held), ("else", f"NOT {held}")):
                    self._gather(schema.get(k, True), names, path, trail, level, f"{guard} AND {test}" if guard else test)
            elif keyword == "anyOf":
                slot(keyword, f"NOT ({' OR '.join(self._kept(c, names, trail) for c in want)})", "shown", one=" is not valid under any of the given schemas")
            elif keyword == "oneOf":
                held = " + ".join(f"CAST({self._kept(c, names, trail)} AS int)" for c in want)
                slot(keyword, f"{held} = 0", "shown", one=" is not valid under any of the given schemas")
                slot(keyword, f"{held} > 1", "shown", one=" is valid under more than one of the given schemas")
            elif keyword == "not":
                slot(keyword, self._kept(want, names, trail), "shown", one=" should not be valid under the given schema")
            elif keyword == "format" and want == "date-time" and self.strict:
                slot(keyword, self._untimed(v), "shown", one=" is not a 'date-time'")

    def _below(self, schema, names: str | None, v: _Value, path: tuple[Step, ...], trail: tuple[str, ...], level: int, guard: str | None) -> None:
        """A level for the members of some names, or for the items."""
        own = len(self._slots)
        self._slots.append([])
        self._children.append([])
        self._gather(schema, (), path, trail, own, None)
        if self._slots[own] or self._children[own]:  # else nothing is asked of them
            self._children[level].append((own, names, v, guard))

    def _places(self, level: int, value: str, at: tuple[str, ...]) -> str:
        """The value and all below it that rules ask for, as an array of (level, at, value)."""
        own = f"named_struct('_level', {level}, '_at', CAST(array({', '.join(at)}) AS array<string>), '_value', {value})"
        parts = []
        for child, names, v, guard in self._children[level]:
            x, i = self._name(), self._name()
            if names is None:
                each = f"transform({v.items}, ({x}, {i}) -> {self._places(child, x, (*at, f'CAST({i} AS string)'))})"
            else:
                each = f"transform({names}, {i} -> {self._places(child, f'try_element_at({v.members}, {i})', (*at, i))})"
            # the places below hold their own base already
            each = (f"CASE WHEN {guard} THEN {each} END" if guard else each).replace(BASE, value)
            parts.append(f"coalesce({f'flatten({each})' if self._children[child] else each}, {NO_PLACES})")
        if parts:
            return f"flatten(array(array({own}), {', '.join(parts)}))"
        return own if level else f"array({own})"

    def _kept(self, schema, names: tuple[str, ...], trail: tuple[str, ...]) -> str:
        """Whether the member ``names`` of a level's value keeps the schema, reached by its path where nothing needs to be looked up in the value."""
        schema, trail = self.resolve(schema, trail)
        if isinstance(schema, bool):
            return str(schema).lower()
        if self._looks_up(schema, trail):
            return self._if_there(reach(BASE, names), lambda x: self._valid(schema, x, trail))
        v = _Reached(names)
        return f"({v.value} IS NULL OR {self._holds(schema, v, trail, names)})"

    def _looks_up(self, schema, trail: tuple[str, ...]) -> bool:
        schema, trail = self.resolve(schema, trail)
        if isinstance(schema, bool):
            return False
        if "items" in schema or "patternProperties" in schema or isinstance(schema.get("additionalProperties"), dict):
            return True
        below = [*schema.get("properties", {}).values(), *(c for k in ("allOf", "anyOf", "oneOf") for c in schema.get(k, ())), *(schema[k] for k in ("not", "if", "then", "else") if k in schema)]
        return any(self._looks_up(c, trail) for c in below)

    @staticmethod
    def _untimed(v: _Value) -> str:
        return f"coalesce({v.kind} = 'string' AND NOT (rlike({v.text}, {literal(ZONED)}) AND try_cast(upper({v.text}) AS timestamp) IS NOT NULL), false)"

    # --- validity

    def _valid(self, schema, value: str, trail: tuple[str, ...]) -> str:
        schema, trail = self.resolve(schema, trail)
        if isinstance(schema, bool):
            return str(schema).lower()
        return f"{self._opened(schema, value, lambda v: self._holds(schema, v, trail))}[0]"

    def _holds(self, schema: dict, v: _Value, trail: tuple[str, ...], names: tuple[str, ...] | None = None) -> str:
        """The test of an opened value, or of the member ``names`` of a level's value."""
        tests = []

        def own(child) -> str:
            return self._valid(child, v.value, trail) if names is None else self._kept(child, names, trail)

        def member(names: str, child) -> str:
            n = self._name()
            return f"coalesce(forall({names}, {n} -> {self._if_there(f'try_element_at({v.members}, {n})', lambda x: self._valid(child, x, trail))}), true)"

        for keyword, want in schema.items():
            if found := self._rule(keyword, schema, v):
                tests.append(f"NOT coalesce({found[0]}, false)")
            elif keyword == "properties" and names is not None:
                tests += [self._kept(c, (*names, n), trail) for n, c in want.items()]
            elif keyword == "properties":
                tests += [self._if_there(f"try_element_at({v.members}, {literal(n)})", lambda x, c=c: self._valid(c, x, trail)) for n, c in want.items()]
            elif keyword == "additionalProperties" and isinstance(want, dict):
                tests.append(member(self._further(schema, v.members), want))
            elif keyword == "patternProperties":
                tests += [member(self._like(p, v.members), c) for p, c in want.items()]
            elif keyword == "items":
                x = self._name()
                tests.append(f"coalesce(forall({v.items}, {x} -> {self._valid(want, x, trail)}), true)")
            elif keyword in ("allOf", "anyOf"):
                tests.append("(" + (" AND " if keyword == "allOf" else " OR ").join(own(c) for c in want) + ")")
            elif keyword == "oneOf":
                tests.append("(" + " + ".join(f"CAST({own(c)} AS int)" for c in want) + ") = 1")
            elif keyword == "not":
                tests.append(f"NOT {own(want)}")
            elif keyword == "if":
                then, other = (own(schema.get(k, True)) for k in ("then", "else"))
                tests.append(f"CASE WHEN {own(want)} THEN {then} ELSE {other} END")
            elif keyword == "format" and want == "date-time" and self.strict:
                tests.append(f"NOT {self._untimed(v)}")
        return "(" + " AND ".join(tests or ["true"]) + ")"


#: A date, a time and a zone.
ZONED = r"(?i)\A\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,9})?(?:Z|[+-]\d\d:\d\d)\z"


def required_of(document: dict, name: str) -> list[str]:
    """What the object under the member ``name`` of the document requires."""
    section, _ = Schema(document).resolve(document["properties"][name], ())
    return list(section.get("required", ()))


def check_documents(df: DataFrame, value: str, schema: Schema, keys: list[str]) -> DataFrame:
    """One row per finding of the VARIANT column ``value``: the key columns, ``path``, ``keyword``, ``message``, in no order."""
    return schema.findings(df, value, keys).select(*keys, *schema.described(F.col("_f"))).select(*keys, "path", "keyword", "message")
