"""The registered queries as SQL over the driver's tables.

Written from the definitions, without the rewrites the engine uses: plain joins, global
windows and grouped text.
"""

from __future__ import annotations

from shelfstream.fixtures import CHANGE_TYPES, STORES
from shelfstream.functions.columns import OTHER_STORE_LABEL, STORE_LABELS
from shelfstream.operators.transactions import MAX_OCTETS
from shelfstream.registry.queries import (
    FIRST_N,
    LOOKUP_STORE_ID,
    LOOKUP_TRANS_ID,
    SPLIT_OCTETS,
)


def _values(rows) -> str:
    return ", ".join(f"({number}, '{text}')" for number, text in rows)


_TABLES = {
    "store": f"""SELECT cast(c0 AS int) AS store_id, c1 AS name
        FROM (VALUES {_values(STORES)}) AS t(c0, c1)""",
    "ict": f"""SELECT cast(c0 AS int) AS change_type_id, c1 AS change_type
        FROM (VALUES {_values(CHANGE_TYPES)}) AS t(c0, c1)""",
    "chg": """SELECT cast(event_id AS varchar) AS trans_id,
          cast(user_id % 2 AS int) AS store_id,
          ts AS date_time,
          CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN 2
            WHEN 'signup' THEN 3 WHEN 'click' THEN 4 END AS change_type_id,
          cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS item_id,
          cast(CASE WHEN event_type = 'signup' THEN floor(value)
            ELSE -floor(value) END AS int) AS quantity
        FROM events WHERE event_type <> 'view'""",
    "snap": """SELECT cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS item_id,
          cast(user_id AS int) AS employee_id,
          cast(user_id % 2 AS int) AS store_id,
          ts AS date_time,
          cast(floor(value) AS int) AS quantity
        FROM events WHERE event_type = 'view'""",
    "snap_seconds": """SELECT item_id, employee_id, store_id,
          date_trunc('second', date_time) AS date_time, quantity FROM snap""",
    "snap_days": """SELECT item_id, employee_id, store_id,
          cast(date_trunc('day', date_time) AS timestamp) AS date_time, quantity FROM snap""",
    "latest": """SELECT item_id, employee_id, store_id, date_time, quantity FROM (
          SELECT *, row_number() OVER (PARTITION BY store_id, item_id
            ORDER BY date_time DESC, quantity DESC, employee_id DESC) AS rn
          FROM snap) WHERE rn = 1""",
    # Which stores book which kinds of change.
    "booked": """SELECT store_id, change_type_id FROM store CROSS JOIN ict
        WHERE name <> 'online' OR change_type <> 'bopis'""",
    "effective": """SELECT store_id, item_id, date_time, quantity
        FROM chg JOIN booked USING (store_id, change_type_id)""",
    "moves": """SELECT store_id, item_id, sum(e.quantity) AS moved,
          max(e.date_time) AS moved_at
        FROM latest JOIN effective AS e USING (store_id, item_id)
        WHERE e.date_time >= latest.date_time
        GROUP BY store_id, item_id""",
    "current_stock": """SELECT store_id, item_id, quantity AS snapshot_quantity,
          cast(coalesce(moved, 0) AS bigint) AS change_quantity,
          cast(quantity + coalesce(moved, 0) AS bigint) AS current_inventory,
          greatest(date_time, moved_at) AS date_time
        FROM latest LEFT JOIN moves USING (store_id, item_id)""",
    "kinds": """SELECT item_id, change_type
        FROM chg LEFT JOIN ict USING (change_type_id)""",
    "report": f"""SELECT cast(date_time AS date) AS date,
          coalesce(label, '{OTHER_STORE_LABEL}') AS store_id, item_id, change_type,
          current_inventory, change_quantity, snapshot_quantity, date_time
        FROM current_stock
          LEFT JOIN (VALUES {_values(STORE_LABELS.items())}) AS names(number, label)
            ON number = current_stock.store_id
          LEFT JOIN kinds USING (item_id)""",
    "raw_lines": """SELECT concat('{', cast(l_orderkey AS varchar), '}') AS trans_id,
          cast(l_partkey AS int) AS item_id,
          cast(o_custkey % 2 AS int) AS store_id,
          o_orderdate AS date_time,
          cast(CASE WHEN o_orderstatus = 'O' THEN l_quantity
            ELSE -l_quantity END AS int) AS quantity,
          CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 3 ELSE 4 END AS change_type_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "lines": """SELECT substr(trans_id, 2, length(trans_id) - 2) AS trans_id,
          item_id, store_id, date_time, quantity, change_type_id FROM raw_lines""",
    "txn": """SELECT date_time, trans_id, min(store_id) AS store_id,
          min(change_type_id) AS change_type_id, count(*) AS n_items,
          string_agg(concat(item_id, ':', quantity), ','
            ORDER BY item_id, quantity) AS items,
          string_agg(concat('{"item_id":', item_id, ',"quantity":', quantity, '}'), ','
            ORDER BY item_id, quantity) AS body
        FROM lines GROUP BY date_time, trans_id""",
    "dedup": """SELECT trans_id, store_id, date_time, change_type_id, item_id, quantity
        FROM (SELECT *, row_number() OVER (PARTITION BY trans_id, item_id
            ORDER BY date_time, quantity, store_id, change_type_id) AS rn
          FROM lines) WHERE rn = 1""",
    "documents_head": """SELECT *, concat('{"date_time":"',
            strftime(date_time, '%Y-%m-%dT%H:%M:%S'), '.000Z","trans_id":"', trans_id,
            '","store_id":', store_id, ',"change_type_id":', change_type_id,
            ',"items":[') AS head FROM txn""",
}

_NEEDS = {
    "snap_seconds": ["snap"],
    "snap_days": ["snap"],
    "latest": ["snap"],
    "booked": ["store", "ict"],
    "effective": ["chg", "booked"],
    "moves": ["latest", "effective"],
    "current_stock": ["latest", "moves"],
    "kinds": ["chg", "ict"],
    "report": ["current_stock", "kinds"],
    "lines": ["raw_lines"],
    "txn": ["lines"],
    "dedup": ["lines"],
    "documents_head": ["txn", "lines"],
}


def _with(select: str, *tables: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in tables:
        add(name)
    ctes = ",\n".join(f"{name} AS ({_TABLES[name]})" for name in ordered)
    return f"WITH {ctes}\n{select}"


def _documents(limit: int, select: str, fraction: str = ".000Z") -> str:
    """``select`` over ``sent``: transactions, those over ``limit`` octets line by line."""
    sent = f"""sent AS (
        SELECT date_time, trans_id, store_id, change_type_id, n_items, items,
          concat(head, body, ']}}') AS document
        FROM documents_head WHERE strlen(concat(head, body, ']}}')) <= {limit}
        UNION ALL
        SELECT h.date_time, h.trans_id, h.store_id, h.change_type_id, 1,
          concat(l.item_id, ':', l.quantity),
          concat(head, '{{"item_id":', l.item_id, ',"quantity":', l.quantity, '}}]}}')
        FROM documents_head h JOIN lines l
          ON h.date_time = l.date_time AND h.trans_id = l.trans_id
        WHERE strlen(concat(head, body, ']}}')) > {limit})"""
    ctes = _with("", "documents_head").rstrip().replace(".000Z", fraction)
    return f"{ctes},\n{sent}\n{select}"


_TXN_COLUMNS = "date_time, trans_id, store_id, change_type_id"
_TXN = _with(f"SELECT {_TXN_COLUMNS}, cast(n_items AS int) AS n_items, items FROM txn", "txn")
_CURRENT = _with("SELECT * FROM current_stock", "current_stock")
_LATEST = _with("SELECT * FROM latest", "latest")
_LINES = _with("SELECT * FROM lines", "lines")
_DEDUP = _with("SELECT * FROM dedup", "dedup")


_ITEMS = """SELECT cast(p_partkey AS int) AS item_id, p_name AS name,
    cast(p_partkey % 100 AS int) AS supplier_id, p_size AS safety_stock_quantity FROM part"""
# The streamed changes: every seventh has no time; what is sent again does not count.
_UNDATED = """SELECT trans_id, store_id,
    CASE WHEN cast(trans_id AS bigint) % 7 <> 0 THEN date_time END AS date_time,
    change_type_id, item_id, quantity FROM chg"""


def _row_text(columns: str) -> str:
    """The named columns as one text, times to the microsecond."""
    text = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')" if c == "date_time" else c
    return "concat_ws('|', " + ", ".join(
        f"coalesce(cast({text(c)} AS varchar), '-')" for c in columns.split()
    ) + ")"


def _gap(by: str) -> str:
    keys = f"{by}date_time, trans_id"
    store = "" if by else "min(store_id) AS store_id, "
    partition = "PARTITION BY store_id " if by else ""
    return _with(
        f"""SELECT store_id, date_time, trans_id, cast(gap AS bigint) AS gap_seconds FROM (
            SELECT *, greatest(coalesce(date_sub('second',
              lag(date_time) OVER ({partition}ORDER BY date_time, trans_id),
              date_time), 0), 0) AS gap
            FROM (SELECT {store}{keys} FROM chg GROUP BY {keys}))""",
        "chg",
    )


def _streamed(select: str, table: str) -> str:
    """``select`` over the changes as they were streamed."""
    return _with(select, table).replace("chg AS (", "sent_chg AS (").replace(
        "\nbooked AS (", f"\nchg AS ({_UNDATED.replace('FROM chg', 'FROM sent_chg')}),\nbooked AS ("
    )


ORACLE_SQL: dict[str, str] = {
    "inventory_current": _CURRENT,
    "inventory_current_by_quantity": _with(
        """SELECT store_id, item_id, snapshot_quantity, change_quantity,
          current_inventory AS current_quantity, date_time FROM current_stock""",
        "current_stock",
    ),
    "inventory_bi": _with("SELECT * FROM report", "report"),
    "inventory_bi_compact": _with(
        """SELECT date, store_id, item_id, change_type, current_inventory, change_quantity,
          snapshot_quantity, date_time, count(*) AS n FROM report GROUP BY ALL""",
        "report",
    ),
    "change_effective": _with("SELECT * FROM effective", "effective"),
    "latest_snapshot": _LATEST,
    "latest_of_store": _with(
        f"SELECT * FROM latest WHERE store_id = {LOOKUP_STORE_ID}", "latest"
    ),
    "txn_assemble": _TXN,
    "txn_json_roundtrip": _TXN,
    "txn_split": _documents(SPLIT_OCTETS, f"SELECT {_TXN_COLUMNS}, document FROM sent"),
    "txn_split_micros": _documents(
        SPLIT_OCTETS, f"SELECT {_TXN_COLUMNS}, document FROM sent", ".000000Z"
    ),
    "first_n_txns": _with(
        f"""SELECT {_TXN_COLUMNS}, items FROM txn
        ORDER BY date_time, trans_id LIMIT {FIRST_N}""",
        "txn",
    ),
    "change_flatten": _with(
        """SELECT trans_id, store_id, date_time, change_type_id,
          cast(split_part(entry, ':', 1) AS int) AS item_id,
          cast(split_part(entry, ':', 2) AS int) AS quantity, event_items
        FROM (SELECT *, cast(n_items AS int) AS event_items,
          unnest(string_split(items, ',')) AS entry FROM txn)""",
        "txn",
    ),
    "change_dedup": _DEDUP,
    "change_lookup": _with(
        f"SELECT * FROM lines WHERE trans_id = '{LOOKUP_TRANS_ID}'", "lines"
    ),
    "snapshot_times": _with("SELECT DISTINCT date_time, store_id FROM snap", "snap"),
    "snapshot_release": _with(
        """SELECT s.store_id, s.date_time, c.date_time AS release_time
        FROM (SELECT DISTINCT store_id, date_time FROM snap) s
        ASOF LEFT JOIN (SELECT DISTINCT date_time FROM chg) c
          ON s.date_time <= c.date_time""",
        "snap",
        "chg",
    ),
    "snapshot_release_by_store": _with(
        """SELECT s.store_id, s.date_time, c.date_time AS release_time
        FROM (SELECT DISTINCT store_id, date_time FROM snap) s
        ASOF LEFT JOIN (SELECT DISTINCT store_id, date_time FROM chg) c
          ON s.store_id = c.store_id AND s.date_time <= c.date_time""",
        "snap",
        "chg",
    ),
    "event_gap": _gap(""),
    "event_gap_by_store": _gap("store_id, "),
    "item_count_distinct": "SELECT count(DISTINCT p_partkey) AS items FROM part",
    "item_count_by_span": _with(
        " UNION ALL ".join(
            f"""SELECT '{unit}' AS span, cast(date_trunc('{unit}', date_time) AS date) AS start,
              count(DISTINCT item_id) AS items, true AS estimate_near FROM chg GROUP BY 2"""
            for unit in ("day", "month", "year")
        ),
        "chg",
    ),
    "fn_trim_braces": _with(
        """SELECT trans_id AS raw_id, substr(trans_id, 2, length(trans_id) - 2) AS trans_id
        FROM raw_lines""",
        "raw_lines",
    ),
    "fn_from_json": """SELECT event_id,
        cast(regexp_extract(props, '([0-9]+)', 1) AS int) AS k FROM events""",
    "fn_date_format": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text
        FROM events""",
    "fn_to_date": "SELECT event_id, cast(ts AS date) AS date FROM events",
    "fn_store_label": """SELECT s_suppkey, CASE s_nationkey WHEN 1 THEN 'Store_01'
        WHEN 0 THEN 'Online_01' ELSE 'Something_new' END AS store_id FROM supplier""",
    "fn_document_time": "SELECT o_orderkey, o_orderdate AS date_time FROM orders",
    "fn_timestamp": "SELECT event_id, ts AS date_time FROM events",
    "src_change_files": _with("SELECT * FROM raw_lines", "raw_lines"),
    "src_snapshot_files": _with("SELECT * FROM snap_seconds", "snap_seconds"),
    "src_item_file": _ITEMS,
    "src_store_file": "SELECT cast(s_suppkey AS int) AS store_id, s_name AS name FROM supplier",
    "src_change_type_file": """SELECT cast(n_nationkey AS int) AS change_type_id,
        n_name AS change_type FROM nation""",
    "snk_snapshot_files": _with("SELECT * FROM snap_seconds", "snap_seconds"),
    "snk_snapshot_files_twice": _with(
        f"SELECT * FROM snap_days WHERE store_id = {LOOKUP_STORE_ID}", "snap_days"
    ),
    "snapshot_of_moment": _with(
        f"""SELECT * FROM snap_days WHERE store_id = {LOOKUP_STORE_ID} AND date_time =
          (SELECT min(date_time) FROM snap_days WHERE store_id = {LOOKUP_STORE_ID})""",
        "snap_days",
    ),
    "snk_inventory_table": _CURRENT,
    "snk_table_refresh": _with("SELECT * FROM effective", "effective"),
    "snk_database": _ITEMS,
    "src_inspect_tables": _with(
        " UNION ALL ".join(
            f"SELECT '{dataset}' AS dataset, {_row_text(columns)} AS row FROM {table}"
            for dataset, table, columns in (
                ("item", f"({_ITEMS})", "item_id name supplier_id safety_stock_quantity"),
                ("inventory_change", "chg",
                 "trans_id store_id date_time change_type_id item_id quantity"),
                ("inventory_snapshot", "snap", "item_id employee_id store_id date_time quantity"),
                ("latest_inventory_snapshot", "latest",
                 "item_id employee_id store_id date_time quantity"),
                ("inventory_current", "current_stock", "store_id item_id snapshot_quantity "
                 "change_quantity current_inventory date_time"),
                ("store", "supplier", "s_suppkey s_name"),
                ("inventory_change_type", "nation", "n_nationkey n_name"),
            )
        ),
        "current_stock",
    ),
    "src_table_stream": _with("SELECT * FROM chg", "chg"),
    "inventory_newest_first": _with(
        """SELECT *, row_number() OVER (
          ORDER BY date_time DESC NULLS LAST, store_id, item_id) AS position
        FROM current_stock""",
        "current_stock",
    ),
    "stream_rate_limit": _with(
        """SELECT count(*) AS n FROM snap, (SELECT (floor(epoch(min(date_time)))
          + floor(epoch(max(date_time)))) / 2 AS cut FROM snap)
        GROUP BY epoch(date_time) >= cut""",
        "snap",
    ),
    "stream_refresh_trigger": _LATEST,
    "snk_publish_text": _LINES,
    "stream_change_dedup": _DEDUP,
    # The earlier part is late but for what lies within an hour of the newest change.
    "stream_late_changes": _with(
        """SELECT trans_id, store_id, date_time, change_type_id, item_id, quantity
        FROM chg, (SELECT max(date_time) AS hi,
          (floor(epoch(min(date_time))) + floor(epoch(max(date_time)))) / 2 AS cut FROM chg)
        WHERE epoch(date_time) >= cut OR date_time > hi - INTERVAL 1 HOUR""",
        "chg",
    ),
    # What is sent: each change, sales twice, and a message that is no document for each error.
    # Those all become one change of nothing. The earlier part comes last and is late but for
    # what lies within an hour of the newest; undated changes never are.
    "stream_change_account": _with(
        f"""SELECT cast(sum(copies + broken) AS bigint) AS messages,
          cast(sum(broken) AS bigint) AS unparseable,
          cast(sum(copies + broken) AS bigint) AS changes,
          cast(sum(CASE WHEN date_time IS NULL THEN copies ELSE 0 END + broken) AS bigint) AS undated,
          cast(sum(CASE WHEN late THEN copies ELSE 0 END) AS bigint) AS late,
          cast(sum(CASE WHEN late THEN 0 ELSE copies - 1 END + broken)
            - least(sum(broken), 1) AS bigint) AS repeated,
          cast(sum(CASE WHEN late THEN 0 ELSE 1 END) + least(sum(broken), 1) AS bigint) AS kept
        FROM (SELECT *, CASE change_type_id WHEN 1 THEN 2 ELSE 1 END AS copies,
            CASE change_type_id WHEN 2 THEN 1 ELSE 0 END AS broken,
            date_time IS NOT NULL AND epoch(date_time) < cut AND date_time <= hi - INTERVAL 1 HOUR AS late
          FROM ({_UNDATED}), (SELECT max(date_time) AS hi,
            (floor(epoch(min(date_time))) + floor(epoch(max(date_time)))) / 2 AS cut FROM ({_UNDATED})))""",
        "chg",
    ),
    "stream_latest_snapshot": _LATEST,
    "stream_snapshot_history": _with("SELECT * FROM snap", "snap"),
    "stream_raw_changes": _documents(
        MAX_OCTETS,
        """SELECT trans_id AS key, document AS value, 'inventory_change' AS topic,
          date_time AS "timestamp", 0 AS "timestampType", true AS no_headers FROM sent""",
    ),
    "stream_change_resend": _with(_UNDATED, "chg"),
    "stream_inventory_current": _streamed("SELECT * FROM current_stock", "current_stock"),
    "stream_inventory_bi": _streamed("SELECT * FROM report", "report"),
}
