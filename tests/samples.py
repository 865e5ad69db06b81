"""Made-up inputs that several test modules share."""


def message(name, dt, temp=11.5, humidity=62, main="Clouds", country="DE", **extra):
    """One observation message; the field names are the format's."""
    made = {
        "name": name,
        "dt": dt,
        "coord": {"lat": 53.25, "lon": 7.5},
        "sys": {"country": country},
        "main": {"temp": temp, "humidity": humidity, "pressure": 1008},
        "wind": {"speed": 2.25},
        "weather": [{"main": main, "description": f"some {main.lower()}"}],
        "visibility": 4200,
    }
    return made | extra
