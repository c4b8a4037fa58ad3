"""A plain interpreter of commands, applied one by one as a server would."""


class Server:
    def __init__(self):
        self.keys = {}
        self.clock = {}

    def apply(self, c):
        """What drops or replaces a key does so whatever its type."""
        if c["op"] == "DEL" or c["op"] == "WRITE" and c["target_type"] == "string":
            for kind in ("string", "hash", "set", "zset"):
                if kind != c["target_type"]:
                    self.apply_typed({**c, "target_type": kind, "op": "DEL"})
        self.apply_typed(c)

    def apply_typed(self, c):
        key = (c["target_type"], c["target_key"])
        now = self.clock[key] = max(self.clock.get(key, c["t"]), c["t"])
        entry = self.keys.get(key)
        if entry and entry["deadline"] <= now:
            entry = None
            del self.keys[key]
        op, ttl = c["op"], c["ttl"]
        if op == "WRITE":
            if entry is None or c["target_type"] == "string":
                entry = self.keys[key] = {"data": {}, "deadline": None}
            if c["target_type"] == "string":
                entry["data"][""] = (c["value"], None)
            elif c["target_type"] == "hash":
                entry["data"].update({f["field"]: (f["value"], None) for f in c["fields"]})
            else:
                entry["data"][c["value"]] = (None, c["score"])
            entry["deadline"] = now + ttl
        elif op == "DEL":
            self.keys.pop(key, None)
        elif entry:
            if op == "REMOVE":
                entry["data"].pop(c["value"], None)
                if not entry["data"]:
                    del self.keys[key]
                    return
            if ttl is not None:
                entry["deadline"] = now + ttl

    def contents(self, as_of):
        return {(*key, item, value, score, e["deadline"])
                for key, e in self.keys.items() if e["deadline"] > as_of
                for item, (value, score) in e["data"].items()}
