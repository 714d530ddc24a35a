"""Hand-written upload documents in the phone's payload form."""

import json


def quantity(value, start, end=None, unit="count", uuid="u", source="Watch6,1", meal=None):
    meta = ""
    if meal:
        meta = f"'foodImageName': 'Egg','foodType': 'Egg dish','USDANumber': '1123','meal': '{meal}'"
    return (
        f"{{'value': {value}, 'unit': '{unit}', 'uuid': '{uuid}', 'source': '{source}', "
        f"'version': '9.1', 'start_time':'{start}', 'end_time':'{end or start}', "
        f"'metadata':{{{meta}}} }}"
    )


def stage(value, start, end, uuid="z", source="Watch6,1"):
    return (
        f"{{'value': {value}, 'uuid': '{uuid}', 'source': '{source}', 'version': '9.1', "
        f"'start_time':'{start}', 'end_time':'{end}'}}"
    )


def document(user="U1", age=34, loaddate="2024-01-05 04:00:00 +0000", gender="Female",
             blood="O+", **arrays):
    return json.dumps(
        {"identifier": user, "age": str(age), "gender": gender, "bloodstype": blood,
         "zip": "10001", "loaddate": loaddate, **arrays}
    )


def records(spark, *documents):
    return spark.createDataFrame([(d,) for d in documents], "record string")


def samples_of(spark, *documents):
    from pulsegrid.operators.extract import samples
    from pulsegrid.sources.documents import parse_documents

    return samples(parse_documents(records(spark, *documents)))
