"""Explicit schemas of everything the engine reads."""

from __future__ import annotations

from pyspark.sql import types as T

# The usage table's counters, in file order.
COUNTERS: tuple[str, ...] = (
    "chat_aicodelines",
    "chat_messagesinteracted",
    "chat_messagessent",
    "codefix_acceptanceeventcount",
    "codefix_acceptedlines",
    "codefix_generatedlines",
    "codefix_generationeventcount",
    "codereview_failedeventcount",
    "codereview_findingscount",
    "codereview_succeededeventcount",
    "dev_acceptanceeventcount",
    "dev_acceptedlines",
    "dev_generatedlines",
    "dev_generationeventcount",
    "docgeneration_acceptedfileupdates",
    "docgeneration_acceptedfilescreations",
    "docgeneration_acceptedlineadditions",
    "docgeneration_acceptedlineupdates",
    "docgeneration_eventcount",
    "docgeneration_rejectedfilecreations",
    "docgeneration_rejectedfileupdates",
    "docgeneration_rejectedlineadditions",
    "docgeneration_rejectedlineupdates",
    "inlinechat_acceptedlineadditions",
    "inlinechat_acceptedlinedeletions",
    "inlinechat_eventcount",
    "inlinechat_rejectedlineadditions",
    "inlinechat_rejectedlinedeletions",
    "inline_aicodelines",
    "inline_acceptancecount",
    "inline_suggestionscount",
    "testgeneration_acceptedlines",
    "testgeneration_acceptedtests",
    "testgeneration_eventcount",
    "testgeneration_generatedlines",
    "testgeneration_generatedtests",
    "transformation_eventcount",
    "transformation_linesgenerated",
    "transformation_linesingested",
)


def _row(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()

#: One row per user and day; the day stays text as landed.
USAGE = _row(("userid", _S), ("act_date", _S), *((name, _I) for name in COUNTERS))

#: The second usage table: a user and a day by another name.
ACTIVITY_LOG = _row(("userid", _S), ("data", _S))

#: Two columns read by position; the file's own header names are ignored.
USER_LIST = _row(("user_id", _S), ("last_activity_date", _S))

#: The landed list of identity instances; the first one names the store to use.
INSTANCES = _row(("page", _I), ("Instances", T.ArrayType(_row(("IdentityStoreId", _S)))))

#: One landed page of an application's assignments, as the service returns it. Pages
#: have a number, or the token they were asked for with.
ASSIGNMENT_PAGE = _row(
    ("application_arn", _S),
    ("page", _I),
    ("ApplicationAssignments", T.ArrayType(_row(("PrincipalType", _S), ("PrincipalId", _S)))),
    ("Token", _S),
    ("NextToken", _S),
)

#: One landed page of a group's memberships. The store is the folder's or the object's.
MEMBERSHIP_PAGE = _row(
    ("identity_store_id", _S),
    ("IdentityStoreId", _S),
    ("GroupId", _S),
    ("page", _I),
    ("GroupMemberships", T.ArrayType(_row(("MemberId", _row(("UserId", _S)))))),
    ("Token", _S),
    ("NextToken", _S),
)

USER_PROFILE = _row(
    ("identity_store_id", _S),
    ("IdentityStoreId", _S),
    ("UserId", _S),
    ("UserName", _S),
    ("DisplayName", _S),
    ("Name", _row(("GivenName", _S), ("FamilyName", _S))),
    ("Emails", T.ArrayType(_row(("Value", _S), ("Primary", _B)))),
)

GROUP_PROFILE = _row(
    ("identity_store_id", _S),
    ("IdentityStoreId", _S),
    ("GroupId", _S),
    ("Group", _row(("DisplayName", _S))),
)
