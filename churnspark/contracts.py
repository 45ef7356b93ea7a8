"""Table contracts: schemas and column roles."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T


@dataclass(frozen=True)
class Roles:
    """Which column plays which part in preparation and modelling."""

    id: str
    target: str
    numeric: tuple[str, ...]
    zero_fill: tuple[str, ...]
    categorical: tuple[str, ...]
    area: str
    region: str
    price: str
    price_flag: str
    leak_numeric: tuple[str, ...]
    leak_categorical: tuple[str, ...]
    segment_features: tuple[str, ...]
    positive: str = "Yes"
    negative: str = "No"

    @property
    def median_fill(self) -> tuple[str, ...]:
        return tuple(c for c in self.numeric if c not in self.zero_fill)

    @property
    def leak(self) -> tuple[str, ...]:
        return self.leak_numeric + self.leak_categorical

    def variant(self, name: str) -> "Roles":
        """``with_retention`` adds the leak suspects, ``without_retention`` does not."""
        if name == "without_retention":
            return self
        if name == "with_retention":
            return replace(self, numeric=self.numeric + self.leak_numeric,
                           categorical=self.categorical + self.leak_categorical)
        raise ValueError(f"unknown feature variant: {name}")


VARIANTS = ("with_retention", "without_retention")

# Column names and roles of the raw telecom snapshot.
TELECOM = Roles(
    id="CustomerID",
    target="Churn",
    numeric=(
        "MonthlyRevenue", "MonthlyMinutes", "TotalRecurringCharge", "DirectorAssistedCalls",
        "OverageMinutes", "RoamingCalls", "PercChangeMinutes", "PercChangeRevenues",
        "DroppedCalls", "BlockedCalls", "UnansweredCalls", "CustomerCareCalls",
        "ThreewayCalls", "ReceivedCalls", "OutboundCalls", "InboundCalls",
        "PeakCallsInOut", "OffPeakCallsInOut", "DroppedBlockedCalls", "CallForwardingCalls",
        "CallWaitingCalls", "MonthsInService", "UniqueSubs", "ActiveSubs",
        "Handsets", "HandsetModels", "CurrentEquipmentDays", "AgeHH1", "AgeHH2",
        "ReferralsMadeBySubscriber", "IncomeGroup", "AdjustmentsToCreditRating",
        "HandsetPrice",
    ),
    zero_fill=("AgeHH1", "AgeHH2"),
    categorical=(
        "ChildrenInHH", "HandsetRefurbished", "HandsetWebCapable", "TruckOwner", "RVOwner",
        "Homeownership", "BuysViaMailOrder", "RespondsToMailOffers", "OptOutMailings",
        "NonUSTravel", "OwnsComputer", "HasCreditCard", "NewCellphoneUser",
        "NotNewCellphoneUser", "OwnsMotorcycle", "CreditRating", "PrizmCode",
        "Occupation", "MaritalStatus", "ServiceArea_Region",
    ),
    area="ServiceArea",
    region="ServiceArea_Region",
    price="HandsetPrice",
    price_flag="HandsetPrice_Unknown",
    leak_numeric=("RetentionCalls", "RetentionOffersAccepted"),
    leak_categorical=("MadeCallToRetentionTeam",),
    segment_features=(
        "MonthlyRevenue", "MonthlyMinutes", "OverageMinutes", "MonthsInService",
        "CurrentEquipmentDays", "DroppedBlockedCalls", "CustomerCareCalls", "ActiveSubs",
    ),
)

# The customer snapshot derived from customer, orders and lineitem.
SNAPSHOT = Roles(
    id="customer_id",
    target="churn",
    numeric=(
        "monthly_revenue", "monthly_minutes", "total_recurring_charge", "overage_minutes",
        "perc_change_minutes", "perc_change_revenues", "customer_care_calls",
        "dropped_blocked_calls", "months_in_service", "active_subs",
        "current_equipment_days", "age_hh1", "age_hh2", "handset_price",
    ),
    zero_fill=("age_hh1", "age_hh2"),
    categorical=("handset_web_capable", "credit_rating", "marital_status",
                 "service_area_region"),
    area="service_area",
    region="service_area_region",
    price="handset_price",
    price_flag="handset_price_unknown",
    leak_numeric=("retention_calls", "retention_offers_accepted"),
    leak_categorical=("made_call_to_retention_team",),
    segment_features=(
        "monthly_revenue", "monthly_minutes", "overage_minutes", "months_in_service",
        "current_equipment_days", "dropped_blocked_calls", "customer_care_calls",
        "active_subs",
    ),
)


def raw_schema(roles: Roles) -> T.StructType:
    """Schema of a raw snapshot: measures are doubles, categories strings.

    The price column stays text, since it mixes numbers with a marker word.
    """
    fields = [T.StructField(roles.id, T.LongType()), T.StructField(roles.target, T.StringType())]
    for c in roles.numeric + roles.leak_numeric:
        fields.append(T.StructField(c, T.StringType() if c == roles.price else T.DoubleType()))
    fields.append(T.StructField(roles.area, T.StringType()))
    for c in roles.categorical + roles.leak_categorical:
        if c != roles.region:
            fields.append(T.StructField(c, T.StringType()))
    return T.StructType(fields)
