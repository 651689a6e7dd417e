import contextlib
import io


def plan_text(df) -> str:
    """The formatted physical plan (what ``df.explain('formatted')`` prints)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def exchange_children(plan: str) -> list[str]:
    """For every hash/range Exchange in the formatted plan tree, the name of
    the operator directly below it."""
    tree = plan.split("\n\n(1)")[0].splitlines()
    out = []
    for i, line in enumerate(tree):
        if "Exchange (" in line and "BroadcastExchange" not in line and "ReusedExchange" not in line:
            depth = line.index("Exchange")
            for nxt in tree[i + 1:]:
                stripped = nxt.lstrip(" :+-")
                if stripped and len(nxt) - len(stripped) >= depth:
                    out.append(stripped.split(" (")[0])
                    break
    return out
