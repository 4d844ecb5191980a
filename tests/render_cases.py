"""Rows with the texts they must render to, written out."""

S, E = "<|im_start|>", "<|im_end|>\n"
OPEN = "<|im_start|>assistant\n"
HEAD = "Below is an instruction that describes a task. Write a response."

EDGE_ROWS = [
    {"id": 0, "instruction": "Sum 2 and 3", "input": "", "output": "5"},
    {"id": 1, "instr": "Translate", "input": "Hallo", "response": "Hello"},
    {"id": 2},
    {"id": 3, "instruction": "", "instr": "b", "output": "", "response": "r"},
    {"id": 4, "instruction": "ignored", "messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
    {"id": 5, "instruction": "q", "messages": None},
    {"id": 6, "instruction": "q2", "input": "ctx", "messages": []},
    {"id": 7, "messages": [{"role": "system", "content": "be brief"}, {"role": "user", "content": "ünïcödé 🙂"}]},
    {"id": 8, "instruction": "multi\nline", "output": "tab\there"},
]

CHAT = {
    0: (f"{S}user\nSum 2 and 3{E}", f"{S}assistant\n5{E}"),
    1: (f"{S}user\nTranslate\nHallo{E}", f"{S}assistant\nHello{E}"),
    2: (f"{S}user\n{E}", f"{S}assistant\n{E}"),
    3: (f"{S}user\nb{E}", f"{S}assistant\nr{E}"),
    4: (f"{S}user\nhi{E}{S}assistant\nyo{E}", ""),
    5: (f"{S}user\nq{E}", f"{S}assistant\n{E}"),
    6: (f"{S}user\nq2\nctx{E}", f"{S}assistant\n{E}"),
    7: (f"{S}system\nbe brief{E}{S}user\nünïcödé 🙂{E}", ""),
    8: (f"{S}user\nmulti\nline{E}", f"{S}assistant\ntab\there{E}"),
}
ALPACA = {
    0: (f"{HEAD}\n\n### Instruction:\nSum 2 and 3\n\n### Response:\n", "5"),
    1: (f"{HEAD}\n\n### Instruction:\nTranslate\n\n### Input:\nHallo\n\n### Response:\n", "Hello"),
    2: (f"{HEAD}\n\n### Instruction:\n\n\n### Response:\n", ""),
    3: (f"{HEAD}\n\n### Instruction:\nb\n\n### Response:\n", "r"),
    5: (f"{HEAD}\n\n### Instruction:\nq\n\n### Response:\n", ""),
    6: (f"{HEAD}\n\n### Instruction:\nq2\n\n### Input:\nctx\n\n### Response:\n", ""),
    8: (f"{HEAD}\n\n### Instruction:\nmulti\nline\n\n### Response:\n", "tab\there"),
}
PLAIN = {
    0: ("User:\nSum 2 and 3\n\nAssistant:\n", "5\n"),
    1: ("User:\nTranslate\nHallo\n\nAssistant:\n", "Hello\n"),
    2: ("User:\n\n\nAssistant:\n", "\n"),
    3: ("User:\nb\n\nAssistant:\n", "r\n"),
    5: ("User:\nq\n\nAssistant:\n", "\n"),
    6: ("User:\nq2\nctx\n\nAssistant:\n", "\n"),
    8: ("User:\nmulti\nline\n\nAssistant:\n", "tab\there\n"),
}


def texts(kind: str, mode: str) -> dict[int, str]:
    """Expected text of every edge row that ``kind`` can render."""
    if kind == "plain":
        return {i: ask + (answer if mode == "train" else "") for i, (ask, answer) in PLAIN.items()}
    out = {i: ask + (answer if mode == "train" else OPEN) for i, (ask, answer) in CHAT.items()}
    if kind == "alpaca":
        out |= {i: ask + (answer if mode == "train" else "") for i, (ask, answer) in ALPACA.items()}
    return out


def chat(turns, open_ended: bool) -> str:
    return "".join(f"{S}{m['role']}\n{m['content']}{E}" for m in turns) + (OPEN if open_ended else "")


def expected(row: dict, alpaca: bool, open_ended: bool) -> str:
    """Of any row: blocks or turns from the first non-empty alias of each field."""
    ask, more, answer = (next((row[n] for n in names if row.get(n)), "") for names in (("instruction", "instr"), ("input",), ("output", "response")))
    turns = row.get("messages")
    if turns:
        return chat(turns, open_ended)
    if alpaca:
        blocks = {"Instruction": ask, **({"Input": more} if more else {}), "Response": "" if open_ended else answer}
        return "\n\n".join([HEAD, *(f"### {name}:\n{body}" for name, body in blocks.items())])
    question = {"role": "user", "content": "\n".join(filter(None, [ask, more])) if ask else ("\n" + more if more else "")}
    return chat([question, *([] if open_ended else [{"role": "assistant", "content": answer}])], open_ended)
