"""Schemas of documents and tables."""

from __future__ import annotations

_LABEL = "struct<value: int, displayName: string>"
EVENT = f"""struct<id: double, eventId: int, minute: int, second: double, teamId: bigint, playerId: bigint, relatedEventId: bigint, relatedPlayerId: bigint,
x: double, y: double, endX: double, endY: double, goalMouthY: double, goalMouthZ: double, blockedX: double, blockedY: double, expandedMinute: int,
period: {_LABEL}, type: {_LABEL}, outcomeType: {_LABEL}, cardType: {_LABEL}, qualifiers: array<struct<type: {_LABEL}, value: string>>,
isTouch: boolean, isShot: boolean, isGoal: boolean>"""
PLAYER = "struct<playerId: bigint, name: string, shirtNo: int, position: string, isFirstEleven: boolean>"
TEAM = f"struct<teamId: bigint, name: string, players: array<{PLAYER}>>"
#: One document per game, named <game_id>.json.
MATCH = f"playerIdNameDictionary map<string, string>, home {TEAM}, away {TEAM}, events array<{EVENT}>"

#: (column, default where the document has none) of an event row, in order, besides game_id and event_ordinal.
EVENT_COLUMNS = (
    "period", "minute", "second", "expanded_minute", "type", "outcome_type", "team_id", "team", "player_id", "player", "x", "y", "end_x", "end_y",
    "goal_mouth_y", "goal_mouth_z", "blocked_x", "blocked_y", "qualifiers", "is_touch", "is_shot", "is_goal", "card_type", "related_event_id",
    "related_player_id",
)

TIERS = "id bigint, name string, tournaments array<struct<id: bigint, name: string>>"
CALENDAR = "mask map<string, map<string, map<string, int>>>"
_FIXTURE = """struct<id: bigint, homeTeamName: string, awayTeamName: string, homeTeamId: bigint, awayTeamId: bigint, startTimeUtc: string,
homeScore: int, awayScore: int, status: int>"""
FIXTURES = f"tournaments array<struct<tournamentId: bigint, matches: array<{_FIXTURE}>>>"

REST_SCHEDULE = """response array<struct<fixture: struct<id: bigint, date: string>, league: struct<id: bigint, name: string>,
teams: struct<home: struct<name: string>, away: struct<name: string>>>>"""
REST_LINEUP = "response array<struct<team: struct<id: bigint, name: string>, startXI: array<struct<player: struct<id: bigint, name: string, number: int>>>>>"
_BET = "struct<name: string, values: array<struct<value: string, odd: string>>>"
REST_ODDS = f"response array<struct<fixture: struct<id: bigint>, bookmakers: array<struct<name: string, bets: array<{_BET}>>>>>"

#: database.table -> (columns, key columns)
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "basis.game": ("id bigint, date date, home_team bigint, away_team bigint, league string, season string, game_minutes int", ("id",)),
    "basis.player": ("id bigint, name string, birthday date, fapi_id bigint", ("id",)),
    "basis.player_alias": ("player_id bigint, source string, source_id string", ("player_id", "source")),
    "basis.teams": ("id bigint, name string", ("id",)),
    "basis.player_game": (
        "player_id bigint, game_id bigint, team_id bigint, minutes int, starter int, goals_for int, goals_against int, kit_number int, is_home int",
        ("player_id", "game_id")
    ),
    "basis.games": (
        "game_id bigint, player_id bigint, minutes int, starter int, opposition_team_id bigint, result string, elo double, "
        "opposition_elo double, game_date date, team_id bigint, expected_game_result_lower double, expected_game_result_upper double, "
        "league string, version double, home int, game_minutes int, valid int", ("game_id", "player_id")
    ),
    "basis.squads": (
        "player_id bigint, kit_number int, team_id bigint, valid_from date, valid_to date",
        ("player_id", "kit_number", "team_id", "valid_from", "valid_to")
    ),
    "basis.schedule": ("schedule_id bigint, date_time timestamp, home string, away string, league bigint", ("schedule_id",)),
    "basis.prediction": (
        "game_id bigint, home_elo double, away_elo double, prediction_low double, prediction_high double, result string", ("game_id",)
    ),
    "metrics.player_game_metric": ("player_id bigint, game_id bigint, metric string, value double", ("player_id", "game_id", "metric")),
    "metrics.base_metric": (
        "player_id bigint, game_id bigint, game_date date, version double, metric string, metric_value double",
        ("player_id", "game_id", "game_date", "version", "metric")
    ),
    "scraping.roster_raw": (
        "kit_number int, name string, nationality string, position string, height string, weight string, date_of_birth string, "
        "place_of_birth string, previous_club string, team string, league string, season string", ("kit_number", "name", "team", "season")
    ),
    "scraping.scrape_log": ("file string", ("file",)),
}
