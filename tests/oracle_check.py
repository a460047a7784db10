"""Run registered queries and their DuckDB oracles side by side and compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        if pd.isna(v) is True:
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item") and not isinstance(v, (list, tuple)):
        try:
            return _norm(v.item())
        except Exception:  # noqa: BLE001
            pass
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    out = []
    for x in row:
        if x is None:
            out.append((0, 0.0, ""))
        elif isinstance(x, (int, float)) and not isinstance(x, bool):
            out.append((1, round(float(x), 6), ""))
        else:
            out.append((2, 0.0, repr(x)))
    return tuple(out)


def frames_equal(a: pd.DataFrame, b: pd.DataFrame, rel: float = float(os.environ.get("ORACLE_REL_TOL", "1e-9"))) -> tuple[bool, str]:
    ca, cb = sorted(a.columns), sorted(b.columns)
    if ca != cb:
        return False, f"columns differ: {ca} vs {cb}"
    if len(a) != len(b):
        return False, f"rows differ: {len(a)} vs {len(b)}"
    ra = sorted((tuple(_norm(v) for v in r) for r in a[ca].itertuples(index=False)), key=_key)
    rb = sorted((tuple(_norm(v) for v in r) for r in b[ca].itertuples(index=False)), key=_key)
    for x, y in zip(ra, rb):
        for c, u, v in zip(ca, x, y):
            if isinstance(u, float) and isinstance(v, (float, int)) or isinstance(v, float) and isinstance(u, (float, int)):
                if u is None or v is None or not math.isclose(float(u), float(v), rel_tol=rel, abs_tol=0.0 if rel == 0 else 1e-12):
                    return False, f"value differs in {c}: {u!r} vs {v!r}\n{x}\n{y}"
            elif u != v:
                return False, f"value differs in {c}: {u!r} vs {v!r}\n{x}\n{y}"
    return True, "ok"


def check(spark, sf_dir: str, keys=None, verbose=True) -> dict[str, str]:
    import __spark_entry__ as E
    qs, ors = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            out[k] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            if verbose:
                print(k, out[k], flush=True)
            continue
        ts = time.time() - t0
        if k not in ors:
            out[k] = f"rows-only ({len(sdf)} rows)"
        else:
            try:
                odf = con.execute(ors[k]).df()
            except Exception as e:  # noqa: BLE001
                out[k] = f"ORACLE ERROR {str(e)[:300]}"
                if verbose:
                    print(k, out[k], flush=True)
                continue
            ok, msg = frames_equal(sdf, odf)
            out[k] = ("PASS" if ok else "FAIL " + msg) + f" ({len(sdf)} rows)"
        if verbose:
            print(f"{k:28s} {ts:6.2f}s {out[k]}", flush=True)
    return out


if __name__ == "__main__":
    from strataflow.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:] or None
    spark = get_spark(master="local[8]", shuffle_partitions=8, driver_memory="8g")
    res = check(spark, sf, keys)
    bad = {k: v for k, v in res.items() if not (v.startswith("PASS") or v.startswith("rows-only"))}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
