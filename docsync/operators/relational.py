"""Joins and aggregates around a parent with team members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsync.functions.text import typed_value as _typed_value
from docsync.operators.concat import ordered_concat
from docsync.sources.changes import changed_between

# Fixed value: the object class of a project team.
PROJECT_CLASS = 1000000


def current_members(members: DataFrame) -> DataFrame:
    return members.where(F.col("current_record") == 1)


def project_teams(team_objects: DataFrame, class_id: int = PROJECT_CLASS) -> DataFrame:
    return team_objects.where(F.col("class_id") == class_id).select("team_id", "object_id")


def member_lists(members: DataFrame, team_objects: DataFrame,
                 class_id: int = PROJECT_CLASS) -> DataFrame:
    """(object_id, user_ids): the current members of each object as a comma list by user id.

    Repeated members are kept.  members: team_id, user_id, current_record;
    team_objects: object_id, team_id, class_id.
    """
    current, teams = current_members(members), project_teams(team_objects, class_id)
    joined = current.select("team_id", "user_id").join(teams, "team_id")
    return ordered_concat(joined, "object_id", F.col("user_id"), lambda user: user.cast("string"),
                          ",", "user_ids", sizes=_list_sizes(current, teams))


def _list_sizes(members: DataFrame, teams: DataFrame) -> DataFrame:
    """(object_id, n): members are counted per team before the join, where they shrink most."""
    per_team = members.groupBy("team_id").agg(F.count(F.lit(1)).alias("n"))
    return per_team.join(teams, "team_id").groupBy("object_id").agg(F.sum("n").alias("n"))


def changed_members(members: DataFrame, lo, hi, mod: str | None = "mod_date",
                    create: str | None = "create_date") -> DataFrame:
    """(team_id, changes): teams with a membership change in the window, and how many."""
    if create is None:
        mod, create = None, mod
    return (changed_between(members, lo, hi, mod, create)
            .groupBy("team_id").agg(F.count(F.lit(1)).alias("changes")))


def changed_parents(parents: DataFrame, parent_id: str, members: DataFrame,
                    team_objects: DataFrame, lo, hi, parent_times=("mod_date", "create_date"),
                    member_times=("mod_date", "create_date"),
                    class_id: int = PROJECT_CLASS) -> DataFrame:
    """Distinct ids of the parents that changed in the window or whose team did.

    Only ids are combined, so the parent rows are joined once afterwards and a parent found by
    both ways comes once.
    """
    own = changed_between(parents, lo, hi, *parent_times).select(F.col(parent_id))
    teams = changed_members(members, lo, hi, *member_times)
    by_team = project_teams(team_objects, class_id).join(teams, "team_id", "left_semi")
    return own.union(by_team.select(F.col("object_id").alias(parent_id))).distinct()


def lists_for(ids: DataFrame, parent_id: str, members: DataFrame, team_objects: DataFrame,
              class_id: int = PROJECT_CLASS) -> DataFrame:
    """member_lists of the given parents only: the rest is dropped before the aggregate."""
    wanted = ids.select(F.col(parent_id).alias("object_id"))
    return member_lists(members, team_objects.join(wanted, "object_id", "left_semi"), class_id)


def repeated_lists(members: DataFrame, team_objects: DataFrame, lo, hi,
                   member_times=("mod_date", "create_date"),
                   class_id: int = PROJECT_CLASS) -> DataFrame:
    """member_lists of the changed teams as a plain join with the change rows gives them.

    A team with k changed members has every user id k times.  The changes are counted first, so
    the k-fold rows never exist; the text is repeated instead.
    """
    teams = changed_members(members, lo, hi, *member_times)
    current = current_members(members)
    linked = project_teams(team_objects, class_id).join(teams, "team_id")
    joined = current.select("team_id", "user_id").join(linked, "team_id")
    return ordered_concat(
        joined, "object_id", F.struct("user_id", F.col("changes").cast("int").alias("changes")),
        lambda item: F.array_join(
            F.array_repeat(item["user_id"].cast("string"), item["changes"]), ","),
        ",", "user_ids", sizes=_list_sizes(current, linked))


def typed_value(rows: DataFrame, string: str = "string_value", date: str = "date_value",
                number: str = "number_value") -> Column:
    return _typed_value(rows, string, date, number)


def typed_attributes(attributes: DataFrame, params: DataFrame) -> DataFrame:
    """(pid, param_name, attribute_value, ...): attribute rows with key name and one text value.

    The parameter table is a dimension; Spark broadcasts it when its size allows.
    """
    joined = attributes.join(params, "param_id")
    rest = [c for c in attributes.columns
            if c not in ("pid", "param_id", "string_value", "date_value", "number_value")]
    return joined.select("pid", "param_name", typed_value(joined).alias("attribute_value"), *rest)
