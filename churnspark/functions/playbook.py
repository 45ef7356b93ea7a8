"""Lookup texts for risk grades and customer segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One action line per risk grade.
GRADE_ACTION = {
    "고위험": "즉시 전담 상담 · 할인/요금제 재설계 · 이탈 방어 쿠폰",
    "중위험": "맞춤 혜택 안내 · 요금제 재안내 · 만족도 설문",
    "저위험": "정기 뉴스레터 · 로열티 포인트 안내",
}

# Follow-up steps per risk grade as (label, title, description).
GRADE_STEPS = {
    "고위험": [
        ("1순위 · 24시간 이내", "전담 상담 연결",
         "요금·통화 품질·단말 문제 중 불편 원인을 먼저 확인하고 상담 이력을 남깁니다."),
        ("2순위 · 상담 직후", "맞춤 유지안 제시",
         "요금제 재설계, 단말 교체 할인, 이탈 방어 쿠폰 중 고객 상황에 맞는 혜택을 제안합니다."),
        ("3순위 · 7일 이내", "사후 확인",
         "혜택 수락 여부와 불편 해소 여부를 확인하고 다음 접촉 필요성을 다시 판단합니다."),
    ],
    "중위험": [
        ("1순위 · 3일 이내", "만족도 확인",
         "간단한 설문이나 안내 전화를 통해 최근 사용 경험과 잠재 불편을 확인합니다."),
        ("2순위 · 1주 이내", "요금제 적합성 점검",
         "사용량과 납부 요금의 불균형을 확인해 더 적합한 요금제나 선택 혜택을 안내합니다."),
        ("3순위 · 30일 관찰", "행동 변화 모니터링",
         "통화량 감소와 고객센터 접촉 증가 여부를 확인해 위험 상승 시 우선 대응합니다."),
    ],
    "저위험": [
        ("정기 관리", "로열티 혜택 안내",
         "포인트와 장기 이용 혜택을 안내해 현재의 안정적인 이용 관계를 유지합니다."),
        ("개인화 안내", "이용 패턴 기반 추천",
         "과도한 할인보다 실제 이용 패턴에 맞는 부가서비스와 사용 팁을 제공합니다."),
        ("분기별 점검", "위험도 재확인",
         "정기 배치 예측으로 위험 등급 변화를 확인하고 불필요한 고객 접촉은 줄입니다."),
    ],
}

# Fixed values: (title, icon, description, actions) per segment.
SEGMENT_PROFILE = {
    "Loyal Long-term Customers": (
        "장기 충성 고객", "🏅",
        "가입 기간과 단말기 사용 기간이 길고, 사용량과 고객센터 이용은 낮은 안정적인 장기 고객군입니다.",
        ["장기 고객 감사 보상 제공", "단말기 교체 할인 또는 업그레이드 혜택 제안",
         "멤버십 등급 및 장기 혜택 강화", "신규 서비스 체험 프로모션 제공"]),
    "Premium Heavy Users": (
        "프리미엄 헤비 유저", "💎",
        "월 매출, 월 사용량, 초과 사용량이 매우 높은 핵심 고객군입니다. "
        "사용 규모가 큰 만큼 품질과 지원 경험이 중요합니다.",
        ["VIP 전용 요금제 또는 전담 혜택 제안", "초과 사용량 패키지 제공",
         "프리미엄 고객 지원 및 우선 응대", "데이터·통화 무제한 상품 전환 제안",
         "장기 유지 보상 제공"]),
    "Multi-line Customers": (
        "다회선 고객", "👨‍👩‍👧‍👦",
        "활성 회선 수가 많지만 회선당 이용량과 매출은 상대적으로 낮은 고객군으로, "
        "가족 또는 복수 회선 고객일 가능성이 높습니다.",
        ["가족 결합 할인 제안", "추가 회선 혜택 제공", "회선별 사용 활성화 프로모션",
         "가족 단위 콘텐츠 및 부가서비스 추천"]),
    "Regular Customers": (
        "일반 고객", "🙂",
        "주요 지표가 평균 또는 평균 이하이며 뚜렷한 극단 특성이 없는 일반적인 고객군입니다.",
        ["기본 유지 프로그램 적용", "관심 서비스 기반 업셀링", "사용량 증가 이벤트 제공",
         "개인화된 요금제 추천"]),
    "High-Maintenance Customers": (
        "집중 관리 고객", "🛠️",
        "사용량이 높고 끊김·차단 통화와 고객센터 접촉이 매우 많은 고객군으로, "
        "서비스 품질 문제와 지원 수요가 큽니다.",
        ["네트워크 및 통화 품질 우선 점검", "전담 상담 또는 우선 응대", "문제 발생 전 선제적 안내",
         "품질 이슈에 대한 적절한 보상", "반복 문의 원인 분석 및 이탈 방어"]),
}

# Profile of a segment that is not listed.
DEFAULT_ICON = "👤"
DEFAULT_DESCRIPTION = "저장된 군집 프로파일을 확인해 고객 특성을 해석하세요."
DEFAULT_ACTION = "군집 프로파일에 맞는 고객 관리 전략을 수립하세요."
STEP_DESCRIPTION = "고객 프로파일과 상담 이력을 확인한 뒤 적용합니다."
STEP_SUFFIX = "순위"

# Recommended steps per segment as (label, title, description).
SEGMENT_STEPS = {
    "Loyal Long-term Customers": [
        ("관계 강화", "장기 이용 보상", "가입 기간에 맞춘 포인트·멤버십 혜택으로 충성도를 보상합니다."),
        ("교체 수요", "단말 업그레이드", "오래된 단말 사용 고객에게 교체 할인과 데이터 이전 지원을 제안합니다."),
        ("경험 확장", "신규 서비스 체험", "신규 부가서비스를 무료 체험하게 해 서비스 활용 범위를 넓힙니다."),
    ],
    "Premium Heavy Users": [
        ("비용 최적화", "대용량 전용 요금제", "초과 사용 비용을 줄일 수 있는 무제한·대용량 상품을 우선 비교합니다."),
        ("서비스 품질", "우선 고객 지원", "장애와 상담 요청에 빠르게 대응할 수 있는 VIP 지원 채널을 안내합니다."),
        ("가치 보상", "프리미엄 리워드", "높은 이용 기여도에 맞춰 장기 유지 보상이나 제휴 혜택을 제공합니다."),
    ],
    "Multi-line Customers": [
        ("결합 강화", "가족·다회선 할인", "회선 수에 맞는 결합 할인과 대표 회선 혜택을 재설계합니다."),
        ("회선 점검", "저활성 회선 관리", "사용량이 낮은 회선을 찾아 요금제 축소나 회선별 맞춤 혜택을 제안합니다."),
        ("가족 경험", "공유형 부가서비스", "데이터 공유, 가족 콘텐츠 등 여러 회선이 함께 쓰는 서비스를 추천합니다."),
    ],
    "Regular Customers": [
        ("관심 파악", "간단 선호도 확인", "채널·콘텐츠·요금 민감도를 확인해 불필요한 일괄 제안을 줄입니다."),
        ("맞춤 제안", "요금제 적합성 안내", "현재 사용량과 비용에 맞는 요금제 한두 개를 비교해 안내합니다."),
        ("참여 유도", "사용 활성화 이벤트", "단기 체험이나 포인트 이벤트로 서비스 이용 경험을 자연스럽게 늘립니다."),
    ],
    "High-Maintenance Customers": [
        ("최우선", "통화 품질 진단", "끊김·차단 통화의 지역과 시간대를 확인하고 네트워크 점검을 요청합니다."),
        ("문의 관리", "전담 상담 케이스", "반복 문의를 하나의 상담 이력으로 묶어 같은 설명을 반복하지 않게 합니다."),
        ("사후 조치", "보상 및 재확인", "문제 수준에 맞는 보상 후 해결 여부를 확인해 추가 이탈 신호를 점검합니다."),
    ],
}

STEPS_SHOWN = 3  # fixed value: steps taken from a plain action list

_STEP = "struct<label:string,title:string,description:string>"


def grade_actions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(GRADE_ACTION.items()),
                                 "risk_grade string, suggested_action string")


def grade_steps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(GRADE_STEPS.items()),
                                 f"risk_grade string, steps array<{_STEP}>")


def segment_profiles(spark: SparkSession) -> DataFrame:
    rows = [(name, *profile, SEGMENT_STEPS.get(name)) for name, profile in SEGMENT_PROFILE.items()]
    return spark.createDataFrame(
        rows, "ClusterName string, title string, icon string, description string, "
              f"actions array<string>, steps array<{_STEP}>")


def suggested_action(df: DataFrame) -> DataFrame:
    """Adds the action line of ``risk_grade`` (three-row dimension)."""
    return df.join(F.broadcast(grade_actions(df.sparkSession)), "risk_grade", "left")


def grade_playbook(df: DataFrame) -> DataFrame:
    """One row per input row and follow-up step of its risk grade."""
    joined = df.join(F.broadcast(grade_steps(df.sparkSession)), "risk_grade", "left")
    return joined.select(*df.columns, F.posexplode("steps").alias("i", "s")).select(
        *df.columns, (F.col("i") + 1).alias("step"), "s.label", "s.title", "s.description")


def segment_playbook(df: DataFrame, profiles: DataFrame | None = None) -> DataFrame:
    """One row per input row and recommended step of its segment.

    A segment without a profile gets the default one; without listed steps the
    first actions are used, labelled by number.
    """
    profiles = segment_profiles(df.sparkSession) if profiles is None else profiles
    joined = df.join(F.broadcast(profiles), "ClusterName", "left")  # one row per segment
    actions = F.coalesce("actions", F.array(F.lit(DEFAULT_ACTION)))
    numbered = F.transform(F.slice(actions, 1, STEPS_SHOWN), lambda a, i: F.struct(
        F.concat((i + 1).cast("string"), F.lit(STEP_SUFFIX)).alias("label"),
        a.alias("title"), F.lit(STEP_DESCRIPTION).alias("description")))
    return joined.select(
        *df.columns,
        F.coalesce("title", "ClusterName").alias("segment_title"),
        F.coalesce("icon", F.lit(DEFAULT_ICON)).alias("segment_icon"),
        F.coalesce("description", F.lit(DEFAULT_DESCRIPTION)).alias("segment_description"),
        F.posexplode(F.coalesce("steps", numbered)).alias("i", "s"),
    ).select(*df.columns, "segment_title", "segment_icon", "segment_description",
             (F.col("i") + 1).alias("step"), "s.label", "s.title", "s.description")
