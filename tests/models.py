"""Sequential models of the dialog and utterance rules, one conversation at a time.

They follow the rules as written in the blueprint, row by row, and share
nothing with the Spark operators but the word lists.
"""

from __future__ import annotations

from parley.operators import utterances as u


def _order(events):
    late = lambda v: (v is None, v if v is not None else 0)
    text = lambda v: (v is None, v or "")
    return sorted(events, key=lambda e: (late(e["time"]), text(e["activity_id"]), e["event_id"]))


def dialogs(events, keep_bounced=False):
    """Set of (label, start, end, left, cancelled, failed, agent)."""
    rows = _order(events)
    talking = {r["activity_id"] for r in rows if r["name"] == "BotMessageReceived" and r["text"] is not None}
    if not talking and not keep_bounced:
        return set()
    valid = {r["instance_id"] for r in rows if r["instance_id"] is not None and r["activity_id"] in talking}

    starts, ends = {}, {}
    for pos, r in enumerate(rows):
        inst = r["instance_id"]
        main = r["step_name"] == "InitialStepAsync" and r["dialog_id"] == "MainDialog.WaterfallDialog"
        agent = r["step_name"] == "EstablishChatStepAsync" and r["dialog_id"] == "WaterfallDialog"
        if inst is not None and ((inst in valid and main) or agent):
            starts[inst] = pos
        over = (
            r["dialog_id"] == "DisambiguateUserUtteranceDialog.WaterfallDialog"
            or r["step_name"] == "FinalStepAsync"
            or r["name"] == "WaterfallComplete"
        )
        if inst is not None and inst in valid and over:
            ends[inst] = pos
    if not starts:
        return set()

    ranked = list(starts)
    closed = [i for i in ranked if i in ends]
    label, left = [None] * len(rows), [False] * len(rows)

    def paint(number, inst, pos, open_ended):
        label[pos] = f"D{number}|{inst}"
        if open_ended:
            left[pos] = True

    if closed:
        for number, inst in enumerate(closed, 1):
            for pos in range(starts[inst], ends[inst] + 1):
                paint(number, inst, pos, False)
        if starts[ranked[-1]] > ends[closed[-1]]:
            for pos in range(starts[ranked[-1]], len(rows)):
                paint(len(closed) + 1, ranked[-1], pos, True)
    else:
        for number, inst in enumerate(ranked, 1):
            final = number == len(ranked)
            stop = len(rows) - 1 if final else starts[ranked[number]]
            for pos in range(starts[inst], stop + 1):
                if final or rows[pos]["instance_id"] in (None, inst):
                    paint(number, inst, pos, True)

    out = set()
    for name in {x for x in label if x}:
        mine = [p for p in range(len(rows)) if label[p] == name]
        part = [rows[p] for p in mine]
        times = [r["time"] for r in part if r["time"] is not None]
        out.add((
            name, min(times, default=None), max(times, default=None), left[mine[0]],
            any(r["intent"] == "Cancel" for r in part),
            any(r["name"] == "FailedUtterance" for r in part),
            any(r["step_name"] == "EstablishChatStepAsync" for r in part),
        ))
    return out


def _number(value):
    try:
        return float(value)
    except (TypeError, ValueError):
        return None


def resolve(events):
    """Resolved activities in first-seen order."""
    rows = _order(events)
    seen = []
    for r in rows:
        wanted = (r["name"] == "BotMessageReceived" and r["text"] is not None) or r["text"] in (u.AGENT_START, u.AGENT_END)
        if wanted and r["activity_id"] is not None and r["activity_id"] not in seen:
            seen.append(r["activity_id"])
    out = []
    for activity in seen:
        part = [r for r in rows if r["activity_id"] == activity and r["name"] in u.RESULT_NAMES]
        messages = [r for r in part if r["name"] == "BotMessageReceived"]
        if not messages:
            continue
        failed = [r for r in part if r["name"] == "FailedUtterance"]
        luis = [r for r in part if r["name"] == "LuisResult"]
        usable = [r for r in luis if r["intent"] not in u.EXCLUDED_INTENTS]
        qna = [r for r in part if r["name"] == "QnAResult"]
        if failed:
            intent, score, source, role = "FailedUtterance", 0.0, failed[0], failed[0]["app_role_name"]
        else:
            intent, score = (usable[-1]["intent"], _number(usable[-1]["intent_score"])) if usable else (None, 0.0)
            source = usable[-1] if usable else luis[0] if luis else part[0]
            role = source["app_role_name"]
            answer = _number(qna[0]["top_answer_score"]) if qna else 0.0
            if score is None or answer is None:
                continue
            if qna:
                role = qna[0]["app_role_name"]
            if answer > score:
                intent, score, source = "QnAResult", answer, qna[0]
        out.append({
            "time": messages[0]["time"], "text": messages[0]["text"], "activity_id": activity, "intent": intent,
            "intent_score": score, "app_role_name": messages[0]["app_role_name"], "child_app_role_name": role,
            "props_conversation_id": source["props_conversation_id"],
            "props_master_conversation_id": source["props_master_conversation_id"],
            "agent_connection": any(r["text"] == u.AGENT_START for r in part),
            "agent_closed": any(r["text"] == u.AGENT_END for r in part),
        })
    for o in out:
        o["resolved"] = _conversation(o)
    return out


def _conversation(o):
    master = o["props_master_conversation_id"]
    return master if master is not None else o["props_conversation_id"]


def _lower(text):
    return text.lower() if text is not None else None


def scores(o):
    intent, s = o["intent"], o["intent_score"]
    role, child = o["app_role_name"], o["child_app_role_name"]
    same, master_bot = role == child, child == u.MASTER_ROLE
    child_bot = child is not None and u.CHILD_ROLE_PART in child
    good, bad = s >= 0.75, 0.01 <= s <= 0.75

    if intent is None:
        m = 0.0
    elif not same and intent != "FailedUtterance":
        m = 0.5
    elif intent == "QnAResult" and master_bot and (good or bad):
        m = 0.5 if good else 0.3
    elif intent == "QnAResult" and not master_bot and child_bot:
        m = 0.5
    elif intent == "IdentifyBrand" or (same and intent != "FailedUtterance"):
        m = 0.3
    else:
        m = 0.0

    if intent is None or (intent == "QnAResult" and master_bot):
        c = 0.0
    elif (intent == "QnAResult" and child_bot and (good or bad)) or (not same and (good or bad)):
        c = 0.5 if good else 0.35
    else:
        c = 0.0
    if o["agent_connection"]:
        m, c = (m - 0.1, c) if same else (m, c - 0.1)
    return round(m, 2), round(c, 2)


def _pass(rows, meets, change):
    gone = set()
    for i in range(len(rows) - 1):
        here, nxt = rows[i], rows[i + 1]
        if here["resolved"] == nxt["resolved"] and meets(here, nxt):
            change(here, nxt)
            gone.add(i + 1)
    return [r for i, r in enumerate(rows) if i not in gone]


def utterances(events):
    """Final utterances as a list of tuples in the output column order."""
    rows = resolve(events)
    for r in rows:
        r["master_score"], r["child_score"] = scores(r)
    rows = [r for r in rows if _lower(r["text"]) not in ("yes", "no", "no, thanks.")]

    def brand(here, nxt):
        return (
            here["intent"] == "IdentifyBrand" and here["app_role_name"] == here["child_app_role_name"]
            and nxt["intent"] != "FailedUtterance" and nxt["text"] is not None
            and nxt["text"].lower().strip() in u.BRANDS
        )

    def take(here, nxt):
        for c in ("intent", "intent_score", "child_app_role_name", "child_score", "props_conversation_id",
                  "props_master_conversation_id"):
            here[c] = nxt[c]

    def connect(here, nxt):
        here["agent_connection"] = True
        which = "master_score" if here["app_role_name"] == here["child_app_role_name"] else "child_score"
        here[which] = round(here[which] - 0.1, 2)

    rows = _pass(rows, brand, take)
    rows = _pass(
        rows, lambda h, n: n["agent_connection"] and (n["text"] is None or n["text"].lower() == "yes, please."), connect
    )
    rows = _pass(rows, lambda h, n: n["agent_connection"] and _lower(n["text"]) in u.AGENT_PHRASES, connect)

    gone = set()
    for conversation in {r["resolved"] for r in rows if r["resolved"] is not None}:
        opened = [i for i, r in enumerate(rows) if r["resolved"] == conversation and r["agent_connection"]]
        closed = [i for i, r in enumerate(rows) if r["resolved"] == conversation and r["agent_closed"]]
        if opened and len(opened) == len(closed):
            for a, z in zip(opened, closed):
                gone.update(range(a + 1, z + 1))
    rows = [r for i, r in enumerate(rows) if i not in gone]

    out = []
    for r in rows:
        if _lower(r["text"]) in ("cancel", "show more", "yes, please."):
            continue
        r["conversation_id"] = _conversation(r)
        r["final_score"] = round(r["master_score"] + r["child_score"], 2)
        out.append(tuple(r[c] for c in u.OUTPUT))
    return out
