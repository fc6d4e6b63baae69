"""The rules of the packaging comparison as data: its breakdowns (O-52) and drills (O-51)."""

from __future__ import annotations

from docket.operators.breakdown import Rule

DIMS = ["packaging_material", "from_nation", "relative_move", "packaging_class", "packaging_activity"]

# Packaging types, classes and activities.
CONSUMER, ORGANISATION = "Self-managed consumer waste", "Self-managed organisation waste"
HOUSEHOLD, NON_HOUSEHOLD = "Total Household packaging", "Total Non-Household packaging"
DRINKS, NON_DRINKS = "Household drinks containers", "Non-household drinks containers"
REUSABLE, BINNED = "Reusable packaging", "Public binned"
TOTAL = [NON_HOUSEHOLD, HOUSEHOLD, BINNED, REUSABLE, DRINKS, NON_DRINKS]
PRIMARY, SECONDARY, TERTIARY, SHIPMENT = "Primary packaging", "Secondary packaging", "Tertiary packaging", "Shipment packaging"
BIN, ONLINE = "Public bin", "Online marketplace total"
ACTIVITIES = {"": "Brand Owner", "_pack": "Packer / Filler", "_Imported": "Imported", "_sold": "Sold as empty", "_hired": "Hired or loaned"}


def _rule(name: str, types: str | list[str], *by: str, classes: list[str] | None = None, activity: str | None = None,
          filled: tuple[str, ...] = ("packaging_material",), blank: tuple[str, ...] = ()) -> Rule:
    where = {"packaging_type": [types] if isinstance(types, str) else types}
    where |= {"packaging_class": classes} if classes else {}
    where |= {"packaging_activity": [activity]} if activity else {}
    return Rule(name, where, filled, blank, ("packaging_material", *by))


NATION, MOVE, CLASS, ACTIVITY = "from_nation", "relative_move", "packaging_class", "packaging_activity"
BREAKDOWNS = [
    _rule("smcw_pm_fn", CONSUMER, NATION, filled=(NATION,), blank=("to_nation",)),  # the one whose material may be blank
    _rule("smcw_pm_rm", CONSUMER, MOVE, filled=("packaging_material", MOVE)),
    _rule("smow_pm_fn", ORGANISATION, NATION, filled=("packaging_material", NATION), blank=("to_nation",)),
    _rule("smow_pm_rm", ORGANISATION, MOVE, filled=("packaging_material", "to_nation")),
    _rule("all_pm_hh_pc", HOUSEHOLD, CLASS, classes=[PRIMARY, BIN, SHIPMENT, ONLINE]),
    _rule("all_pm_non_hh_pc", NON_HOUSEHOLD, CLASS, classes=[ONLINE, PRIMARY, SECONDARY, SHIPMENT, TERTIARY]),
    _rule("all_pm_hh_drinks", DRINKS),
    _rule("all_pm_non_hh_drinks", NON_DRINKS),
    _rule("all_pm_drinks", [NON_DRINKS, DRINKS]),
    _rule("all_pm_reusable", REUSABLE, CLASS),
    _rule("all_pm_TP", TOTAL),
    _rule("all_pm_Thh", HOUSEHOLD),
    _rule("all_pm_Tnhh", NON_HOUSEHOLD),
    _rule("all_pm_TReusable", REUSABLE),
    _rule("all_pm_hh_pa", HOUSEHOLD, CLASS, ACTIVITY, classes=[PRIMARY, SHIPMENT]),
    _rule("all_pm_pb_pa", BINNED, CLASS, ACTIVITY, classes=[BIN]),
    _rule("all_pm_tnh_pa", NON_HOUSEHOLD, CLASS, ACTIVITY),
    _rule("all_pm_pa_HH_drinks", DRINKS, ACTIVITY),
    _rule("all_pm_pa_nHH_drinks", NON_DRINKS, ACTIVITY),
    _rule("all_pm_pa_all_drinks", [NON_DRINKS, DRINKS], ACTIVITY),
    _rule("all_pm_pa_reusable", REUSABLE, CLASS, ACTIVITY),
    _rule("all_pm_pa_tp", TOTAL, ACTIVITY),
    _rule("all_pm_pa_total_hh", HOUSEHOLD, ACTIVITY),
    _rule("all_pm_pa_total_nonhh", NON_HOUSEHOLD, ACTIVITY),
    _rule("all_pm_pa_total_reusable", REUSABLE, ACTIVITY),
    _rule("all_pm_online", HOUSEHOLD, CLASS, classes=[ONLINE]),
    _rule("all_public_binned", BINNED, CLASS, classes=[BIN]),
    _rule("all_pm_online_non", NON_HOUSEHOLD, CLASS, classes=[ONLINE]),
]

# A drill asks for a material and the values of ``by``; eleven measures exist for each activity.
_MEASURES = [("all_pm_hh_pa", HOUSEHOLD, (CLASS,)), ("all_pm_pb_pa", BINNED, (CLASS,)), ("all_pm_tnh_pa", NON_HOUSEHOLD, (CLASS,)),
             ("all_pm_pa_HH_drinks", DRINKS, ()), ("all_pm_pa_nHH_drinks", NON_DRINKS, ()), ("all_pm_pa_all_drinks", [NON_DRINKS, DRINKS], ()),
             ("all_pm_pa_reusable", REUSABLE, (CLASS,)), ("all_pm_pa_tp", TOTAL, ()), ("all_pm_pa_total_hh", HOUSEHOLD, ()),
             ("all_pm_pa_total_nonhh", NON_HOUSEHOLD, ()), ("all_pm_pa_total_reusable", REUSABLE, ())]
DRILLS = [
    _rule("relative_move", CONSUMER, MOVE), _rule("from_nation", CONSUMER, NATION),
    _rule("from_org", ORGANISATION, NATION), _rule("relative_move_org", ORGANISATION, MOVE),
    _rule("hp_all", HOUSEHOLD, CLASS), _rule("nhp_all", NON_HOUSEHOLD, CLASS), _rule("hdc_all", DRINKS), _rule("nhdc_all", NON_DRINKS),
    _rule("drinks_all", [NON_DRINKS, DRINKS]), _rule("rp_all", REUSABLE, CLASS), _rule("tp_all", TOTAL), _rule("hp_all_total", HOUSEHOLD),
    _rule("nhp_all_total", NON_HOUSEHOLD), _rule("rp_all_total", REUSABLE), _rule("all_pm_online", HOUSEHOLD, CLASS),
    _rule("all_pm_tnh_pa_online", NON_HOUSEHOLD, CLASS), _rule("all_public_binned", BINNED, CLASS), _rule("all_pm_online_non", NON_HOUSEHOLD, CLASS),
    *[_rule(name + suffix, types, *by, activity=activity) for suffix, activity in ACTIVITIES.items() for name, types, by in _MEASURES],
]
