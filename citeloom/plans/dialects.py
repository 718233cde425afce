"""The two dialects that a plan is written in: Spark SQL to run, and the oracle's SQL to compare with."""

from __future__ import annotations


class Spark:
    name = "spark"

    def rx(self, pattern: str) -> str:
        return "r'" + pattern.replace("'", r"\x27") + "'"

    def has(self, x: str, pattern: str) -> str:
        return f"({x} RLIKE {self.rx(pattern)})"

    def found(self, x: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract_all({x}, {self.rx(pattern)}, {group})"

    def replaced(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, {self.rx(pattern)}, '{by}')"

    def at(self, array: str, i: int) -> str:
        return f"get({array}, {i})"

    def each(self, array: str) -> str:
        return f"explode({array})"

    def set_join(self, x: str) -> str:
        return f"array_join(array_sort(collect_set({x})), ',')"

    def list_join(self, x: str, sep: str, *order: str) -> str:
        return f"array_join(transform(array_sort(collect_list(struct({', '.join(order)}, {x} AS joined))), e -> e.joined), '{sep}')"

    def joined(self, array: str, sep: str = ",") -> str:
        return f"array_join({array}, '{sep}')"

    def kept(self, array: str, var: str, test: str) -> str:
        return f"filter({array}, {var} -> {test})"

    def mapped(self, array: str, var: str, to: str) -> str:
        return f"transform({array}, {var} -> {to})"

    def sorted(self, array: str) -> str:
        return f"array_sort({array})"

    def array(self, *items: str) -> str:
        return f"array({', '.join(items)})"

    def distinct_sorted(self, array: str) -> str:
        return f"array_sort(array_distinct({array}))"

    def overlap(self, a: str, b: str) -> str:
        return f"size(array_intersect({a}, {b}))"

    def size(self, array: str) -> str:
        return f"size({array})"

    def part(self, array: str, n: int) -> str:
        return f"slice({array}, 1, {n})"

    def argmax(self, x: str, key: str, tie: str) -> str:
        return f"max_by({x}, struct({key}, -{tie}))"

    def json(self, x: str, key: str) -> str:
        return f"get_json_object({x}, '$.{key}')"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) div ({b}))"

    def year(self, x: str) -> str:
        return f"year({x})"

    def sha256(self, x: str) -> str:
        return f"sha2({x}, 256)"

    def title_case(self, x: str) -> str:
        return f"initcap({x})"

    def table(self, name: str, sf_dir: str) -> str:
        return f"{name} AS (SELECT * FROM parquet.`{sf_dir}/{name}.parquet`)"


class Duck(Spark):
    name = "duck"

    def rx(self, pattern: str) -> str:
        return "'" + pattern.replace("'", r"\x27") + "'"

    def has(self, x: str, pattern: str) -> str:
        return f"regexp_matches({x}, {self.rx(pattern)})"

    def replaced(self, x: str, pattern: str, by: str) -> str:
        return f"regexp_replace({x}, {self.rx(pattern)}, '{by}', 'g')"

    def at(self, array: str, i: int) -> str:
        return f"({array})[{i + 1}]"

    def each(self, array: str) -> str:
        return f"unnest({array})"

    def set_join(self, x: str) -> str:
        return f"coalesce(string_agg(DISTINCT {x}, ',' ORDER BY {x}), '')"

    def list_join(self, x: str, sep: str, *order: str) -> str:
        return f"coalesce(string_agg({x}, '{sep}' ORDER BY {', '.join(order)}), '')"

    def joined(self, array: str, sep: str = ",") -> str:
        return f"array_to_string({array}, '{sep}')"

    def kept(self, array: str, var: str, test: str) -> str:
        return f"list_filter({array}, lambda {var}: {test})"

    def mapped(self, array: str, var: str, to: str) -> str:
        return f"list_transform({array}, lambda {var}: {to})"

    def sorted(self, array: str) -> str:
        return f"list_sort({array})"

    def array(self, *items: str) -> str:
        return f"[{', '.join(items)}]"

    def distinct_sorted(self, array: str) -> str:
        return f"list_sort(list_distinct({array}))"

    def overlap(self, a: str, b: str) -> str:
        return f"len(list_intersect({a}, {b}))::INTEGER"

    def size(self, array: str) -> str:
        return f"len({array})::INTEGER"

    def part(self, array: str, n: int) -> str:
        return f"({array})[1:{n}]"

    def argmax(self, x: str, key: str, tie: str) -> str:
        return f"arg_max({x}, ({key}, -{tie}))"

    def json(self, x: str, key: str) -> str:
        return f"json_extract_string({x}, '$.{key}')"

    def div(self, a: str, b: str) -> str:
        return f"(({a}) // ({b}))"

    def year(self, x: str) -> str:
        return f"year({x})::INTEGER"

    def sha256(self, x: str) -> str:
        return f"sha256({x})"

    def title_case(self, x: str) -> str:
        return f"array_to_string(list_transform(string_split({x}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"

    def table(self, name: str, sf_dir: str) -> str:
        raise NotImplementedError("the oracle registers its tables")
