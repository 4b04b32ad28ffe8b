"""Day-by-day model of the state machine in plain Python, for small test inputs."""

from __future__ import annotations

import random
from datetime import timedelta


def replay(daily_rows, start, end, cfg):
    """Every state row of start..end as {(key, date): row}. `daily_rows` are dicts.

    The feed of a day is any row, or any row of the key's opco, by cfg.feed_scope.
    """
    by_day = {}
    for row in daily_rows:
        by_day.setdefault(row["snapshot_date"], {})[row["subscription_key"]] = row
    out, yesterday, ds = {}, {}, start
    while ds <= end:
        today = by_day.get(ds, {})
        state = {}
        for key in yesterday.keys() | today.keys():
            opco = (today.get(key) or yesterday.get(key))["opco_code"]
            feed = any(r["opco_code"] == opco for r in today.values()) if cfg.feed_scope == "opco" else bool(today)
            row = _next(yesterday.get(key), today.get(key), feed, ds, cfg)
            if row is not None:
                state[key] = row
                out[(key, ds)] = row
        yesterday, ds = state, ds + timedelta(days=1)
    return out


def _next(y, t, feed, ds, cfg):
    paying = (1 if t else 0) if feed else (y["activity_array"][0] if y else 0)
    viewer = t["is_viewer_today"] if t else 0
    minutes = t["minutes_of_usage"] if t else 0.0
    last_active = ds if paying else (y["last_active_date"] if y else None)
    if last_active is None:
        return None
    idle = (ds - last_active).days
    churned = int(not paying and idle > cfg.grace_days)
    grace = int(not paying and not churned)
    if not (paying or grace or idle <= cfg.retention_days):
        return None
    was_churned = bool(y and y["is_churned"])
    was_active = bool(y and y["is_active_subscription"])
    open_days = (ds - y["churn_date"]).days if y and y["churn_date"] else None
    churn_event = int(churned and not was_churned)
    winback = int(bool(paying and was_churned and open_days <= cfg.winback_days))
    reacquired = int(bool(paying and was_churned and open_days > cfg.winback_days))
    known = lambda name: (t[name] if t and t[name] is not None else (y[name] if y else None))
    sub_id = known("subscription_id")
    first = y["first_active_date"] if y else ds
    reference = ds if churn_event else (y["churn_date"] if y else None)
    since = (ds - reference).days if reference else None

    def history(value, name):
        return ([value] + (y[name] if y else []))[: cfg.array_size]

    act, view, mou = history(paying, "activity_array"), history(viewer, "viewer_array"), history(minutes, "mou_array")
    src = t or y
    row = {
        "opco_code": src["opco_code"], "subscription_key": src["subscription_key"],
        "subscriber_id": src["subscriber_id"], "subscription_name": src["subscription_name"],
        "subscription_id": sub_id, "activity_array": act, "viewer_array": view, "mou_array": mou,
        "first_active_date": first, "last_active_date": last_active,
        "paid_through_date": known("paid_through_date"),
        "churn_date": ds if churn_event else (None if paying else (y["churn_date"] if y else None)),
        "last_churn_date": ds if churn_event else (y["last_churn_date"] if y else None),
        "last_winback_date": ds if winback else (y["last_winback_date"] if y else None),
        "is_paying": paying, "is_in_grace": grace, "is_active_subscription": max(paying, grace),
        "is_churned": churned, "is_in_winback_window": int(bool(churned and since <= cfg.winback_days)),
        "is_addition": int(bool(paying and not was_active)), "is_new_subscription": int(bool(paying and not y)),
        "is_winback_event": winback, "is_reacquisition_event": reacquired, "is_churn_event": churn_event,
        "is_renewal_event": int(bool(
            paying and was_active and sub_id is not None and y["subscription_id"] is not None
            and sub_id != y["subscription_id"]
        )),
        "days_since_last_active": idle, "days_since_churn": since, "tenure_days": (ds - first).days,
        "is_viewer_1d": view[0], "mou_1d": mou[0], "snapshot_date": ds,
    }
    for name, n in {"7d": 7, "30d": 30, "90d": cfg.array_size}.items():
        row[f"is_viewer_{name}"] = int(sum(view[:n]) > 0)
        row[f"active_days_{name}"] = sum(act[:n])
        row[f"mou_{name}"] = sum(mou[:n])
    return row


def random_daily(seed, keys, start, end, gap_rate=0.1, viewer_minutes=1.0):
    """Daily rows with runs of paying days, long pauses, id changes, NULL ids and feed gaps."""
    rng = random.Random(seed)
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    feed = {d for d in days if rng.random() >= gap_rate}
    rows = []
    for k in range(keys):
        opco, subscriber, name = f"OP{k % 2}", f"s{k // 3}", f"plan{k % 3}"
        paying, sub_id = rng.random() < 0.5, 0
        stay, back = rng.choice([(0.95, 0.05), (0.7, 0.3), (0.5, 0.02), (0.9, 0.01)])
        for d in days:
            paying = rng.random() < (stay if paying else back)
            if not paying or d not in feed:
                continue
            sub_id += rng.random() < 0.2
            minutes = float(rng.choice([0, 0, 0.25, 0.75, 1, 5, 12.5]))
            rows.append({
                "opco_code": opco, "subscription_key": f"{opco}|{subscriber}|{name}",
                "subscriber_id": subscriber, "subscription_name": name,
                "subscription_id": None if rng.random() < 0.1 else f"i{sub_id}",
                "is_paying_today": 1, "is_viewer_today": int(minutes >= viewer_minutes),
                "minutes_of_usage": minutes, "subscription_start_date": d,
                "paid_through_date": None if rng.random() < 0.1 else d + timedelta(days=5),
                "snapshot_date": d,
            })
    return rows
