"""A reader for the `arrow_ranges` source: Parquet rows that meet a predicate on `k`."""


def batches(predicate, options):
    import pyarrow.compute as pc
    import pyarrow.dataset as ds

    clauses = predicate.replace("(", "").replace(")", "").replace("`k`", "k").split(" AND ")
    expression = None
    for clause in clauses:
        parts = []
        for term in clause.split(" OR "):
            if term.strip() == "k IS NULL":
                parts.append(pc.field("k").is_null())
            elif term.strip() == "1=1":
                parts.append(pc.scalar(True))
            else:
                _, op, value = term.split()
                field = pc.field("k")
                parts.append(field < int(value) if op == "<" else field >= int(value))
        whole = parts[0]
        for part in parts[1:]:
            whole = whole | part
        expression = whole if expression is None else expression & whole
    yield from ds.dataset(options["data"]).to_batches(filter=expression, batch_size=int(options.get("batch_rows", 1000)))
